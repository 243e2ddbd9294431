"""Partition independence and property checks against brute force."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from clickpulse.functions.text import java_split, split_ids
from clickpulse.operators import conversion

from .conftest import SF_SMALL, rows

QUERIES = E.queries()


def test_results_do_not_depend_on_shuffle_partitions(spark):
    names = ["category_session_top10", "page_conversion", "area_product_top3",
             "blacklist_users", "user_ad_day_counts", "day_area_ads_top3_json"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = {}
        for n_parts in ("1", "8", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n_parts)
            got[n_parts] = {n: rows(QUERIES[n](spark, SF_SMALL)) for n in names}
        assert got["1"] == got["8"] == got["13"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


_session = st.lists(
    st.tuples(st.integers(0, 2),  # session
              st.integers(0, 5),  # hour
              st.integers(0, 59),  # minute
              st.integers(1, 4)),  # page
    min_size=0, max_size=40)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_session)
def test_bucketed_pairs_equal_one_window_per_session(spark, acts):
    data = [(f"s{s}", f"2024-01-01 {h:02d}:{m:02d}:00.{i:06d}", p) for i, (s, h, m, p) in enumerate(acts)]
    df = spark.createDataFrame(data, "session_id string, action_time string, page_id long")
    got = _expanded(conversion.consecutive_pairs(df))
    w = Window.partitionBy("session_id").orderBy("action_time", "page_id")
    plain = (df.select(F.col("page_id").alias("from_page"), F.lead("page_id").over(w).alias("to_page"))
             .where(F.col("to_page").isNotNull()))
    assert got == sorted(map(tuple, plain.collect()))


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab,", max_size=8), min_size=1, max_size=20))
def test_split_ids_matches_java_rules(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "ids string")
    got = [r["a"] for r in df.select(split_ids(F.col("ids")).alias("a")).collect()]
    assert got == [java_split(t) for t in texts]


def _expanded(pairs):
    return sorted((r.from_page, r.to_page) for r in pairs.collect() for _ in range(r.n))


def test_slices_split_a_hot_session(spark):
    # one session with nearly all actions, all inside one minute
    data = [("hot", f"2024-01-01 10:00:00.{i:06d}", i % 4 + 1) for i in range(4000)]
    data += [(f"s{i}", "2024-01-01 11:00:00.000000", 1) for i in range(20)]
    df = spark.createDataFrame(data, "session_id string, action_time string, page_id long").repartition(6)
    assert {(r.from_page, r.to_page): r.n for r in conversion.consecutive_pairs(df).collect()} == {
        (1, 2): 1000, (2, 3): 1000, (3, 4): 1000, (4, 1): 999}


def test_only_slice_edges_reach_the_second_level(spark):
    """One row per slice is joined to the next; equal rows, null and single-row sessions included."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = [(f"s{i % 3}", f"2024-01-01 10:00:00.{i // 6:06d}", i % 5) for i in range(600)]
        data += [(None, "2024-01-01 10:00:00.000000", 1)] * 3 + [("one", "2024-01-01 10:00:00.000000", 2)]
        df = spark.createDataFrame(data, "session_id string, action_time string, page_id long")
        keys = ("session_id", "action_time", "page_id")
        rows_ = df.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).select("session_id", "page_id") \
            .mapInArrow(conversion._count_slice, conversion.SLICE)
        assert 1 < rows_.where("n = 0").count() <= 8
        by = {}
        for s, t, p in sorted(x for x in data if x[0] is not None):
            by.setdefault(s, []).append(p)
        want = sorted((a, b) for ps in by.values() for a, b in zip(ps, ps[1:]))
        assert _expanded(conversion.consecutive_pairs(df)) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
