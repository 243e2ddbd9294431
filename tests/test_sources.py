"""Catalog and JDBC sinks, the offline application."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickpulse.operators import area, category
from clickpulse.sources import jdbc
from clickpulse.sources.catalog import CatalogTables, save_table
from clickpulse.sources.fixtures import MallTables
from clickpulse.sources.schemas import USER_VISIT_ACTION, SchemaMismatch, decode

from .conftest import SF_SMALL, rows

def _save_mall(spark, database):
    t = MallTables(spark, SF_SMALL)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in [("user_visit_action", t.visits()), ("user_info", t.users()), ("city_info", t.cities()),
                     ("product_info", t.products())]:
        save_table(df, f"{database}.{name}")
    return t


def test_tables_through_the_catalog(spark):
    mall = _save_mall(spark, "mall_test")
    _save_mall(spark, "mall_test")  # replaces, does not append
    t = CatalogTables(spark, "mall_test")
    assert rows(t.visits()) == rows(mall.visits()) and t.users().count() == mall.users().count()
    bound = ("2024-01-05", "2024-01-20")
    assert rows(t.visits(*bound)) == rows(mall.visits(*bound)) != rows(mall.visits())
    assert rows(category.category_top10(t.visits(), "t")) == rows(category.category_top10(mall.visits(), "t"))
    assert rows(area.area_product_top3(t.visits(), t.cities(), t.products())) == rows(
        area.area_product_top3(mall.visits(), mall.cities(), mall.products()))


def test_save_table_partitioned_and_decode(spark):
    df = MallTables(spark, SF_SMALL).visits()
    save_table(df, "visits_by_day", partition_by=["date"])
    back = spark.table("visits_by_day").where(F.col("date") == "2024-01-06")
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        back.explain()
    assert "PartitionFilters: [isnotnull(date" in buf.getvalue()
    assert rows(decode(spark.table("visits_by_day"), USER_VISIT_ACTION)) == rows(df)
    with pytest.raises(SchemaMismatch):
        decode(df.drop("city_id"), USER_VISIT_ACTION)


def test_jdbc_target_properties():
    t = jdbc.JdbcTarget("jdbc:mysql://db/mall", user="u", password="p", batch_size=500)
    assert t.properties() == {"batchsize": "500", "user": "u", "password": "p"}


def test_offline_app_writes_the_four_results(spark):
    import __spark_entry__ as E
    from clickpulse.plans.offline import run_offline
    from clickpulse.plans.params import COND, TASK_ID
    from clickpulse.sources.fixtures import MallTables

    from .conftest import SF_SMALL

    spark.sql("CREATE DATABASE IF NOT EXISTS mall_out")
    run_offline(MallTables(spark, SF_SMALL), COND, TASK_ID,
                lambda df, name, mode: save_table(df, f"mall_out.{name}"))
    q = E.queries()
    for table, query in [("category_top10", "category_top10"),
                         ("category_top10_session_count", "category_session_top10"),
                         ("page_conversion_rate", "page_conversion"),
                         ("area_product_click", "area_product_top3")]:
        assert rows(spark.table(f"mall_out.{table}")) == rows(q[query](spark, SF_SMALL)), table


class _Recorder:
    """Stands in for DataFrame / DataFrameWriter and records the calls."""

    def __init__(self, log):
        self.log = log

    def coalesce(self, n):
        self.log.append(("coalesce", n))
        return self

    @property
    def write(self):
        return self

    def mode(self, m):
        self.log.append(("mode", m))
        return self

    def option(self, k, v):
        self.log.append(("option", k, v))
        return self

    def jdbc(self, url, table, properties=None):
        self.log.append(("jdbc", url, table, dict(properties or {})))


@pytest.mark.parametrize("fn,expected", [
    (jdbc.overwrite, [("mode", "overwrite")]),
    (jdbc.truncate_insert, [("mode", "overwrite"), ("option", "truncate", "true")]),
    (jdbc.append, [("mode", "append")]),
])
def test_jdbc_writer_calls(fn, expected):
    log = []
    target = jdbc.JdbcTarget("jdbc:mysql://db/mall", user="u", password="p", max_writers=4)
    fn(_Recorder(log), target, "category_top10")
    assert log[0] == ("coalesce", 4)
    assert log[1:-1] == expected
    assert log[-1] == ("jdbc", "jdbc:mysql://db/mall", "category_top10",
                       {"batchsize": "1000", "user": "u", "password": "p"})


def test_cli_offline_writes_tables(spark, tmp_path):
    import json

    import __spark_entry__ as E
    from clickpulse.cli import main
    from clickpulse.plans.params import COND, TASK_ID

    from .conftest import SF_SMALL

    cond = tmp_path / "cond.json"
    cond.write_text(json.dumps({"startDate": COND.start_date, "endDate": COND.end_date,
                                "startAge": str(COND.start_age), "endAge": str(COND.end_age),
                                "targetPageFlow": COND.target_page_flow}))
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_out")
    main(["offline", "--sf-dir", SF_SMALL, "--condition", str(cond), "--task-id", TASK_ID,
          "--out-database", "cli_out"])
    q = E.queries()
    assert rows(spark.table("cli_out.page_conversion_rate")) == rows(q["page_conversion"](spark, SF_SMALL))
    assert rows(spark.table("cli_out.category_top10")) == rows(q["category_top10"](spark, SF_SMALL))


def test_r3_keeps_its_history(spark):
    from clickpulse.cli import main

    _save_mall(spark, "hist_db")
    for run in ("r1", "r2"):
        main(["--time-zone", "UTC", "offline", "--database", "hist_db", "--task-id", run, "--out-database", "hist_db",
              "--condition", str(_flow_file())])
    seen = {r.task_id for r in spark.table("hist_db.page_conversion_rate").select("task_id").distinct().collect()}
    assert seen == {"r1", "r2"}
    assert {r.task_id for r in spark.table("hist_db.category_top10").select("task_id").distinct().collect()} == {"r2"}


def _flow_file():
    import tempfile
    from pathlib import Path

    p = Path(tempfile.mkdtemp()) / "c.json"
    p.write_text('{"targetPageFlow": "1,2,3"}')
    return p


def test_jdbc_write_mode_of_each_result(spark, monkeypatch):
    from clickpulse import cli

    calls = []
    for name in ("overwrite", "truncate_insert", "append"):
        monkeypatch.setitem(jdbc.WRITERS, name, lambda df, target, table, n=name: calls.append((table, n)))
    cli.main(["offline", "--sf-dir", SF_SMALL, "--jdbc-url", "jdbc:mysql://db/mall", "--condition", str(_flow_file())])
    assert dict(calls) == {"category_top10": "truncate_insert", "category_top10_session_count": "truncate_insert",
                           "page_conversion_rate": "append", "area_product_click": "overwrite"}


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from clickpulse import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session())
