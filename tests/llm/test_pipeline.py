from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from clickpulse.llm import queries, quality, repeats, secret_scan, simhash
from clickpulse.llm.common import written
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import helpers as H
from tests.llm.test_tokens import verify


def stages(spark, docs, sf_dir):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), "t"))
    return out


def test_stages_against_brute_force(spark):
    docs = spark.createDataFrame([r for r in H.odd_rows() if r[0] is not None and r[0] not in (8, 9, 15)], H.SCHEMA)
    _, good, single, cut, clean, packed = stages(spark, docs, SF_SMALL)
    for kept in (good, single, cut, clean):
        assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = {r.doc_id for r in quality.quality_rules(docs).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == ids
    near = H.components(sorted(ids), lambda a, b: (
        simhash.fingerprint(texts[a].encode()) ^ simhash.fingerprint(texts[b].encode())).bit_count() <= 2)
    assert {r.doc_id for r in single.collect()} == set(near.values())
    want = {i: n for i, n, *_ in H.without_repeats([(r.doc_id, r.text) for r in single.collect()], 200)}
    removed = {i: k for i, _, k, _, _ in H.without_repeats([(r.doc_id, r.text) for r in single.collect()], 200)}
    for r in cut.collect():
        assert 0 <= len(r.text.encode()) - (want[r.doc_id] - removed[r.doc_id]) + 6 <= 6 and r.n_chars == len(r.text)
    verify([(r.doc_id, r.text) for r in clean.collect()], packed.collect(), 2048)


def test_near_dedup_of_odd_rows_leaves_one_row_per_group(spark):
    docs = H.odd_documents(spark).union(spark.createDataFrame(
        [(None, t, "en", None, None, "clash", 7, 8, 9) for t in (H.words(31, 90), H.words(31, 90), H.words(1, 120))], H.SCHEMA))
    _, good, single, cut, _, _ = stages(spark, docs, SF_SMALL)
    texts = sorted({r.text for r in good.collect()})
    near = H.components(texts, lambda a, b: (
        simhash.fingerprint(a.encode()) ^ simhash.fingerprint(b.encode())).bit_count() <= 2)
    kept = single.collect()
    assert len(kept) == len(set(near.values())) < good.count()
    assert {near[r.text] for r in kept} == set(near.values())
    # a clean passage of a repeated document is still there after the repeated passages are cut
    assert [r.text for r in cut.collect() if r.doc_id is None and r.text] == [H.words(31, 90)]


def test_run_on_documents(spark):
    pieces = corpus_pipeline.run(spark, SF_SMALL)
    docs = queries.table(spark, SF_SMALL, "documents")
    kept = quality.keep_good(docs)
    assert pieces.select("doc_id").distinct().count() == simhash.one_per_group(kept).count()


def test_secrets_are_marked(spark):
    docs = queries.table(spark, SF_CHECK, "documents")
    out = corpus_pipeline.secrets(spark, docs, SF_CHECK)
    left = secret_scan.scan(out, None).agg({"n_assign": "sum", "n_access": "sum", "n_hex": "sum"}).first()
    assert set(left) == {0} and out.count() == docs.count()


def test_empty_documents(spark):
    docs = H.no_documents(spark)
    for kept in stages(spark, docs, SF_SMALL):
        assert kept.count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_on_the_small_tables(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    if name in queries.ORACLE:
        for t in ("documents", "embeddings"):
            duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
        want = duckdb.sql(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE[name]})").fetchall()
        assert sorted(map(tuple, df.collect())) == sorted(want)
    else:
        assert df.count() >= 200


def test_repeats_query_matches_brute_force(spark):
    docs = queries.table(spark, SF_SMALL, "documents")
    got = queries.QUERIES["op4_difference_cover"](spark, SF_SMALL).collect()
    want = H.without_repeats([(r.doc_id, r.text) for r in docs.collect()], repeats.LENGTH)
    assert sorted(map(tuple, got)) == sorted(want)


def test_secrets_are_learnt_from_all_findings(spark, monkeypatch):
    docs = queries.table(spark, SF_SMALL, "documents")
    labels = [r.y for r in secret_scan.labelled(docs).collect()]
    held, real = [], secret_scan.CharCnn.settle
    monkeypatch.setattr(secret_scan, "sample", None)
    monkeypatch.setattr(secret_scan, "_judged", lambda packed, *_: packed)
    monkeypatch.setattr(secret_scan.CharCnn, "settle", lambda cnn, z, y, n, **k: (
        held.append((n[y == 0].sum(), n[k["kinds"] == "base"].sum())), real(cnn, z, y, n, **k))[1])
    out = corpus_pipeline.secrets(spark, docs, SF_SMALL)
    assert out.count() == docs.count()
    assert held == [((labels.count(False) + secret_scan.RESAMPLED // 4) // 4, labels.count(True) // 4)]
