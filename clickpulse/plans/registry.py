"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through :class:`MallTables`, so its
work grows with the input. Parameters come from :mod:`clickpulse.plans.params`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators import ads, area, category, conversion
from clickpulse.plans.condition import Condition, filter_visits
from clickpulse.plans.params import (
    BLACKLIST_THRESHOLD,
    COND,
    COND_PROPERTIES,
    LAST_HOUR_DAY_MS,
    LAST_HOUR_END_MS,
    LAST_HOUR_SLOT_MS,
    LAST_HOUR_SPAN_MS,
    SLOT_MS,
    TASK_ID,
    USER_BUCKETS,
)
from clickpulse.session import materialized, scratch_dir
from clickpulse.sources import catalog, hashview
from clickpulse.sources.fixtures import MallTables
from clickpulse.streaming import replay
from clickpulse.streaming.app import realtime_tables

Query = Callable[[SparkSession, str], DataFrame]


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = MallTables(spark, sf_dir)
    return filter_visits(t.visits(*COND.ts_bounds()), t.users(), COND)


def _condition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(spark, sf_dir)


def _action_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = category.classify_actions(_filtered(spark, sf_dir))
    return c.select("session_id", "action_time", "page_id", "kind")


def _explode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category.explode_ids(_filtered(spark, sf_dir))


def _category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category.category_counts(_filtered(spark, sf_dir))


def _category_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category.category_top10(_filtered(spark, sf_dir), TASK_ID)


def _category_session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category.top_category_session_counts(_filtered(spark, sf_dir), TASK_ID)


def _category_session_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    # R1 and R2 from one scan of the visits
    return category.top_category_sessions(_filtered(spark, sf_dir), TASK_ID)[1]


def _page_denominator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion.page_denominator(_filtered(spark, sf_dir), COND.target_page_flow)


def _page_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion.page_transitions(_filtered(spark, sf_dir), COND.target_page_flow)


def _page_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion.page_conversion(_filtered(spark, sf_dir), COND.target_page_flow, TASK_ID)


def _area_product_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = MallTables(spark, sf_dir)
    return area.area_product_city_counts(t.visits(), t.cities(), t.products())


def _city_remark(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = MallTables(spark, sf_dir)
    return area.area_product_clicks(t.visits(), t.cities(), t.products())


def _area_product_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = MallTables(spark, sf_dir)
    return area.area_product_top3(t.visits(), t.cities(), t.products())


def _area_product_top3_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    MallTables(spark, sf_dir).register_views()
    return area.area_product_top3_sql(spark)


def _ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MallTables(spark, sf_dir).ads()


def _ads_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ads.to_lines(_ads(spark, sf_dir))
    return ads.with_time_text(ads.good_lines(ads.parse_ad_lines(lines)))


def _blacklist_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.blacklist_users(_ads(spark, sf_dir), BLACKLIST_THRESHOLD, SLOT_MS)


def _blacklist_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.blacklist_replay(_ads(spark, sf_dir), BLACKLIST_THRESHOLD, SLOT_MS)


def _user_ad_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.blacklist_counters(_ads(spark, sf_dir), BLACKLIST_THRESHOLD, SLOT_MS)


def _day_area_city_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.day_area_city_ads(_ads(spark, sf_dir))


def _day_area_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.day_area_ads(_day_area_city_ads(spark, sf_dir))


def _day_area_ads_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.day_area_ads_top3(_day_area_ads(spark, sf_dir))


def _day_area_ads_top3_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.day_area_ads_top3_json(_day_area_ads_top3(spark, sf_dir))


def _last_hour_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = ads.last_hour_bounds(LAST_HOUR_END_MS, LAST_HOUR_SPAN_MS, LAST_HOUR_SLOT_MS)
    clicks = MallTables(spark, sf_dir).ads(lo, hi)
    return ads.last_hour_minutes(clicks, LAST_HOUR_END_MS, LAST_HOUR_SPAN_MS, LAST_HOUR_SLOT_MS)


def _last_hour_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.minutes_json(_last_hour_minutes(spark, sf_dir))


def _stream_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.blacklist(spark, sf_dir).blacklist.current_blacklist(spark)


def _stream_blacklist_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.blacklist(spark, sf_dir, keep_clicks=True).blacklist.kept_clicks(spark)


def _stream_blacklist_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the list as a process that did not run the stream reads it
    rt = replay.blacklist(spark, sf_dir)
    return realtime_tables(rt.base_dir, BLACKLIST_THRESHOLD).blacklist.current_blacklist(spark)


def _stream_blacklist_counters_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.blacklist(spark, sf_dir).blacklist.current_counters(spark)


def _stream_day_area_city_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.day_area(spark, sf_dir).day_area.current_counts(spark)


def _stream_day_area_city_ads_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.day_area(spark, sf_dir, unordered=True).day_area.current_counts(spark)


def _stream_day_area_ads_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.day_area(spark, sf_dir).day_area.current_top3(spark)


def _stream_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.last_hour(spark, sf_dir).last_hour.current_trend(spark)


def _ads_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the ad log spoilt in four ways, by event; the rejected ones and why."""
    clicks = _ads(spark, sf_dir)
    n = F.pmod(F.col("ts"), F.lit(11))
    ts = F.col("ts").cast("string")
    first = (F.when(n == 1, F.concat(F.lit("x"), ts)).when(n == 2, F.concat(ts, F.lit("000000000000")))
             .when(n == 3, F.concat(ts, F.lit("000"))).when(n == 4, F.lit("")).otherwise(ts))
    line = F.when(n == 0, F.concat_ws(",", ts, "area")).otherwise(
        F.concat_ws(",", first, "area", "city", "user_id", "ads_id"))
    return ads.bad_lines(ads.parse_ad_lines(clicks.select(line.alias("value")))).withColumnRenamed("_error", "error")


def _day_area_city_ads_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashview.day_area_city_ads_hash(_day_area_city_ads(spark, sf_dir))


def _day_area_ads_top3_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashview.day_area_ads_top3_hash(_day_area_ads_top3_json(spark, sf_dir))


def _last_hour_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashview.last_hour_hash(_last_hour_json(spark, sf_dir))


def _condition_from_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condition parsed from the original's properties text."""
    cond = Condition.from_properties(COND_PROPERTIES)
    t = MallTables(spark, sf_dir)
    return filter_visits(t.visits(*cond.ts_bounds()), t.users(), cond)


def _area_product_clicks_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The remark as a SQL function over (city, count) rows."""
    MallTables(spark, sf_dir).register_views()
    return area.area_product_clicks_sql(spark)


def _condition_filter_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + J1: the mall tables saved as managed tables bucketed by user, read back and joined."""
    db = f"mall_{uuid.uuid4().hex[:12]}"
    catalog.create_database(spark, db, scratch_dir(spark, "mall"))
    catalog.save_mall(MallTables(spark, sf_dir), db, USER_BUCKETS)
    t = catalog.CatalogTables(spark, db)
    return filter_visits(t.visits(COND.start_date, COND.end_date), t.users(), COND)


def _blacklist_replay_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3/S11 for a list too long to broadcast."""
    clicks = _ads(spark, sf_dir)
    flags = materialized(ads.blacklist_users(clicks, BLACKLIST_THRESHOLD, SLOT_MS), "flags")
    return ads.kept_clicks_long_list(clicks, flags, SLOT_MS, flags.count())


def _last_hour_all_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last-hour trend at every 5 s slide of a day."""
    lo, hi = LAST_HOUR_DAY_MS
    clicks = MallTables(spark, sf_dir).ads(lo - LAST_HOUR_SPAN_MS, hi)
    panes = ads.pane_counts(clicks, LAST_HOUR_SLOT_MS)
    return ads.slides_json(ads.slide_minutes(panes, lo, hi, LAST_HOUR_SPAN_MS, LAST_HOUR_SLOT_MS))


def _stream_blacklist_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.blacklist(spark, sf_dir, unordered=True).blacklist.current_blacklist(spark)


def _stream_blacklist_replay_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6/T7 when every batch holds late clicks: the kept clicks of the batch form."""
    return replay.blacklist(spark, sf_dir, keep_clicks=True, unordered=True).blacklist.kept_clicks(spark)


def _stream_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 with the count in the engine's state store."""
    return replay.running_counts(spark, sf_dir).current(spark)


QUERIES: dict[str, Query] = {
    "condition_filter": _condition_filter,
    "action_classify": _action_classify,
    "explode_ids": _explode_ids,
    "category_counts": _category_counts,
    "category_top10": _category_top10,
    "category_session_counts": _category_session_counts,
    "category_session_top10": _category_session_top10,
    "page_denominator": _page_denominator,
    "page_transitions": _page_transitions,
    "page_conversion": _page_conversion,
    "area_product_clicks": _area_product_clicks,
    "city_remark": _city_remark,
    "area_product_top3": _area_product_top3,
    "area_product_top3_sql": _area_product_top3_sql,
    "ads_parse": _ads_parse,
    "user_ad_day_counts": _user_ad_day_counts,
    "blacklist_users": _blacklist_users,
    "blacklist_replay": _blacklist_replay,
    "day_area_city_ads": _day_area_city_ads,
    "day_area_ads": _day_area_ads,
    "day_area_ads_top3": _day_area_ads_top3,
    "day_area_ads_top3_json": _day_area_ads_top3_json,
    "last_hour_minutes": _last_hour_minutes,
    "last_hour_json": _last_hour_json,
    "stream_blacklist": _stream_blacklist,
    "stream_blacklist_replay": _stream_blacklist_replay,
    "stream_blacklist_state": _stream_blacklist_state,
    "stream_blacklist_counters_state": _stream_blacklist_counters_state,
    "stream_day_area_city_ads": _stream_day_area_city_ads,
    "stream_day_area_city_ads_unordered": _stream_day_area_city_ads_unordered,
    "stream_day_area_ads_top3": _stream_day_area_ads_top3,
    "stream_last_hour": _stream_last_hour,
    "ads_rejects": _ads_rejects,
    "day_area_city_ads_hash": _day_area_city_ads_hash,
    "day_area_ads_top3_hash": _day_area_ads_top3_hash,
    "last_hour_hash": _last_hour_hash,
    "condition_from_properties": _condition_from_properties,
    "area_product_clicks_sql": _area_product_clicks_sql,
    "condition_filter_bucketed": _condition_filter_bucketed,
    "blacklist_replay_bloom": _blacklist_replay_bloom,
    "last_hour_all_slides": _last_hour_all_slides,
    "stream_blacklist_unordered": _stream_blacklist_unordered,
    "stream_blacklist_replay_unordered": _stream_blacklist_replay_unordered,
    "stream_running_counts": _stream_running_counts,
}
