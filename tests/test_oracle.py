"""Every registered query against its DuckDB oracle on the driver's tables."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from compare import duck_conn, rows_of  # noqa: E402

from .conftest import SF_CHECK, SF_SMALL  # noqa: E402

ORACLE = E.oracle_sql()
QUERIES = E.queries()
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
          "boolean": "BOOLEAN"}
_DUCK: dict[str, object] = {}


def _duck(sf_dir):
    if sf_dir not in _DUCK:
        _DUCK[sf_dir] = duck_conn(sf_dir)
    return _DUCK[sf_dir]


def test_every_query_has_an_oracle_or_is_documented():
    missing = sorted(set(QUERIES) - set(ORACLE))
    # the training-data operators without SQL are tested against brute force in tests/llm
    assert all(n.startswith(("op", "pipeline")) for n in missing), missing
    assert set(ORACLE) <= set(QUERIES)


# stream replays restart seven times each: one size here, the other in the driver's own run
CASES = [(n, d) for n in sorted(ORACLE) for d in (SF_SMALL, SF_CHECK) if d == SF_SMALL or not n.startswith("stream_")]


@pytest.mark.parametrize("name,sf_dir", CASES)
def test_query_matches_oracle(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    res = _duck(sf_dir).execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)
    mine = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    rel = _duck(sf_dir).sql(ORACLE[name])
    assert mine == dict(zip(rel.columns, [str(t) for t in rel.types]))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["area", "product_name", "click_count", "city_remark", "rank"]
    assert df.count() == 23
