"""Plan shapes that matter at scale, checked on AQE's final plans."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from clickpulse.operators import ads
from clickpulse.session import scratch_dir

from .conftest import SF_CHECK, SF_SMALL

QUERIES = E.queries()


def final_plan(spark, name: str, sf_dir: str = SF_SMALL) -> str:
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    return text.split("== Initial Plan ==")[0]


def events_scans(plan: str) -> int:
    return len(re.findall(r"FileScan parquet [^\n]*events\.parquet", plan))


@pytest.mark.parametrize("name", ["category_top10", "page_conversion",
                                  "area_product_top3", "day_area_ads_top3_json"])
def test_fact_table_read_once(spark, name):
    assert events_scans(final_plan(spark, name)) == 1


@pytest.mark.parametrize("name", ["category_session_top10", "area_product_top3", "day_area_ads_top3"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    plan = final_plan(spark, name)
    # a partial WindowGroupLimit below the exchange and the final one above it
    assert plan.count("WindowGroupLimit") >= 2, plan


OWN = sorted(n for n in QUERIES if not n.startswith(("stream_", "op", "pipeline")))


@pytest.mark.parametrize("name", OWN)
def test_no_cartesian_joins_and_pruned_scans(spark, name):
    plan = final_plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        # no query needs every column of events: `value` is never read
        assert "value:double" not in schema, (name, schema)


def test_counts_are_combined_map_side(spark):
    plan = final_plan(spark, "area_product_top3")
    assert "partial_count" in plan
    # the first shuffle after the scan carries (city_id, product_id) partial counts
    first = plan[plan.rfind("Exchange hashpartitioning"):]
    assert "city_id" in first and "partial_count" in plan[plan.rfind("Exchange hashpartitioning"):]


@pytest.mark.parametrize("name", ["condition_filter", "category_top10", "category_session_top10", "page_conversion",
                                  "last_hour_json", "last_hour_minutes"])
def test_time_range_reaches_the_scan(spark, name):
    scans = re.findall(r"FileScan parquet [^\n]*events\.parquet[^\n]*", final_plan(spark, name))
    assert scans and all("GreaterThanOrEqual(ts" in s and "LessThan(ts" in s for s in scans), scans


def test_pages_are_shuffled_once(spark):
    plan = final_plan(spark, "page_conversion")
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("MapInArrow") == 1


def test_sessions_are_counted_after_the_semi_join(spark):
    """Only actions of the top categories reach the (category, session) shuffle."""
    plan = final_plan(spark, "category_session_counts", SF_CHECK)
    shuffle = plan.index("Exchange hashpartitioning(category_id")
    below = plan[shuffle:]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below
    assert below.index("partial_count") < below.index("LeftSemi")


def test_blacklist_needs_no_placement_by_user(spark):
    plan = final_plan(spark, "blacklist_users", SF_CHECK)
    # slot counts and the window by (user, day, ad), then a partial minimum per user
    assert "partial_min" in plan and "hashpartitioning(user_id" in plan
    assert not re.search(r"REPARTITION_BY", plan)


def test_counter_table_shares_one_scan(spark):
    plan = final_plan(spark, "user_ad_day_counts", SF_CHECK)
    assert events_scans(plan) == 1 and "ReusedExchange" in plan


def test_bucketed_visits_join_users_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(spark, "condition_filter_bucketed")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    scans = re.findall(r"FileScan parquet [^\n]*user_(?:visit_action|info)\[[^\n]*", plan)
    assert len(scans) == 2 and all("Bucketed: true" in s for s in scans), plan


def _children(plan: str, node: str) -> list[str]:
    """The subtrees below the first ``node`` of a printed plan, without those of subqueries."""
    lines = [x for x in plan.splitlines() if re.match(r"^[\s:|]*(\+- |:- )", x)]
    depth = [len(re.match(r"^[\s:|]*(\+- |:- )", x).group(0)) for x in lines]
    at = next(i for i, x in enumerate(lines) if x[depth[i]:].startswith(node))
    out, skip = [], None
    for x, d in zip(lines[at + 1:], depth[at + 1:]):
        if d <= depth[at]:
            break
        if skip is not None and d > skip:
            continue
        skip = d if re.match(r"(Reused)?Subquery", x[d:]) else None
        if d == depth[at] + 3:
            out.append("")
        out[-1] += ("" if skip is not None else x[d:]) + "\n"
    return out


def test_unlisted_users_clicks_are_not_shuffled(spark):
    """Of all clicks only those that the Bloom filter lets through reach the exchange under the exact join."""
    users = 3000
    clicks = spark.range(users * 4).selectExpr("id * 1000 as ts", "'n' as area", "'A' as city",
                                               f"concat('u', id % {users}) as user_id", "'1' as ads_id")
    base = scratch_dir(spark, "bloom")
    clicks.write.parquet(f"{base}/clicks")
    spark.range(60).selectExpr("concat('u', id * 7) as user_id", "1000L as flag_slot").write.parquet(f"{base}/flags")
    clicks, flags = spark.read.parquet(f"{base}/clicks"), spark.read.parquet(f"{base}/flags")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        kept = ads.kept_clicks_long_list(clicks, flags, 1000, 60)
        want = sorted(map(tuple, ads.kept_clicks(clicks, flags, 1000).collect()))
        got = sorted(map(tuple, kept.collect()))
        buf = io.StringIO()
        with redirect_stdout(buf):
            kept.explain()
        plan = buf.getvalue().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert got == want
    sure, maybe = _children(plan, "Union")
    assert "Exchange" not in sure and "Filter" in sure, sure  # surely unlisted: scanned and passed on
    assert "Exchange hashpartitioning(user_id" in maybe and "SortMergeJoin" in maybe, maybe
    # and its filter lies below that exchange
    below = maybe[maybe.index("Exchange hashpartitioning(user_id"):]
    assert "scalar-subquery" in below.split("FileScan")[0] or "Subquery" in below.split("FileScan")[0], below
    words = ads.bloom_words(60)
    bits = ads.bloom_filter(flags, "user_id", words).first()["bits"]
    assert len(bits) == words
    may = clicks.where(ads.might_contain(F.lit(bits), F.col("user_id"), words))
    listed = clicks.join(flags, "user_id", "left_semi").count()
    assert listed <= may.count() < 0.1 * clicks.count()
