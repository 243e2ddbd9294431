"""R6, R7, R8 on a stream.

Each micro-batch adds its own counts to versioned ``sum`` tables: R6 per (day,
area, city, ad), R8 per (ad, slot, minute label). No watermark is needed: a late
click is added to its day or slot whenever it comes, clicks that the blacklist takes
back are subtracted, and days follow the session time zone like the batch form. For the
days a batch touches the top-3 ads per area (R7) are ranked again from the table,
which is bucketed by day.

R8's trend is a function of the clock: :meth:`LastHour.trend_at` computes it for
any instant, :meth:`LastHour.publish` stores it, and the application publishes
both after a batch and on a timer, so it moves when no click comes. Slots that no
later trend can show are not kept.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.operators import ads
from clickpulse.sources import hashview
from clickpulse.sources.versions import CommitLog, VersionedTable

DAY_AREA_CITY_ADS = T.StructType([
    T.StructField("day", T.StringType()), T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("ads_id", T.StringType()),
    T.StructField("cnt", T.LongType())])
DAY_AREA_ADS_TOP3 = T.StructType([
    T.StructField("day", T.StringType()), T.StructField("area", T.StringType()),
    T.StructField("ads_id", T.StringType()), T.StructField("cnt", T.LongType()),
    T.StructField("rank", T.LongType())])
AD_SLOT_COUNTS = T.StructType([
    T.StructField("ads_id", T.StringType()), T.StructField("slot", T.LongType()),
    T.StructField("hm", T.StringType()), T.StructField("cnt", T.LongType())])
LAST_HOUR_JSON = T.StructType([
    T.StructField("ads_id", T.StringType()), T.StructField("minutes_json", T.StringType())])


def less(count, kept: DataFrame, back: DataFrame | None) -> DataFrame:
    """``count`` of the kept clicks, less that of the clicks taken back (rows with a negative ``cnt``)."""
    out = count(kept)
    return out if back is None else out.unionByName(count(back).withColumn("cnt", -F.col("cnt")))


class DayArea:
    """R6 counts (S9) and the R7 ranking of the touched days."""

    def __init__(self, path: str, log: CommitLog, top: int = 3, compact_every: int = 10, buckets: int = 16):
        by = dict(bucket_by=["day"], compact_every=compact_every, buckets=buckets)
        self.counts = VersionedTable(f"{path}/day_area_city_ads", DAY_AREA_CITY_ADS, log, "sum",
                                     ["day", "area", "city", "ads_id"], **by)
        self.top3 = VersionedTable(f"{path}/day_area_ads_top3", DAY_AREA_ADS_TOP3, log, "latest", ["day"], **by)
        self.top = top

    def tables(self) -> list[VersionedTable]:
        return [self.counts, self.top3]

    def store(self, kept: DataFrame, batch_id: int, back: DataFrame | None = None) -> None:
        spark = kept.sparkSession
        self.counts.write(less(ads.day_area_city_ads, kept, back), batch_id)
        # the days come from the increments just written, not from the clicks again
        days = self.counts._read(spark, [self.counts.version_path(batch_id)]).select("day").distinct()
        cur = self.counts.current(spark, batch_id, only=days)
        top = ads.day_area_ads_top3(ads.day_area_ads(cur), self.top)
        # a day whose last clicks were taken back gets a row without rank, which replaces its ranking
        self.top3.write(days.join(top, "day", "left"), batch_id)

    def current_counts(self, spark: SparkSession) -> DataFrame:
        return self.counts.current(spark)

    def current_top3(self, spark: SparkSession) -> DataFrame:
        return self.top3.current(spark).where(F.col("rank").isNotNull())

    def counts_hash(self, spark: SparkSession) -> DataFrame:
        """R6 as (key, field, value) rows of the original layout."""
        return hashview.day_area_city_ads_hash(self.current_counts(spark))

    def top3_hash(self, spark: SparkSession) -> DataFrame:
        """R7 as (key, field, value) rows of the original layout."""
        return hashview.day_area_ads_top3_hash(ads.day_area_ads_top3_json(self.current_top3(spark)))


class LastHour:
    """Clicks per (ad, slot, minute), and the minute trend of the last hour as JSON.

    The slot is the click's event-time slot, or with ``arrival`` the slot of the
    instant its batch ran; the label is the click's own minute either way.
    """

    def __init__(self, path: str, log: CommitLog, slot_ms: int = 5_000, span_ms: int = 3_600_000,
                 arrival: bool = False, compact_every: int = 10,
                 now_ms: Callable[[], int] | None = None):
        self.slots = VersionedTable(f"{path}/ad_slot_counts", AD_SLOT_COUNTS, log, "sum",
                                    ["ads_id", "slot", "hm"], [], compact_every)
        self.published = CommitLog(f"{path}/trend_commits")
        self.trend = VersionedTable(f"{path}/last_hour_json", LAST_HOUR_JSON, self.published, "whole")
        self.slot_ms, self.span_ms, self.arrival = slot_ms, span_ms, arrival
        self.now_ms = now_ms or (lambda: int(time.time() * 1000))
        self._one = threading.Lock()

    def tables(self) -> list[VersionedTable]:
        return [self.slots]

    def live(self):
        """Slots that a trend from now on can still show."""
        return F.col("slot") >= ads.last_hour_bounds(self.now_ms(), self.span_ms, self.slot_ms)[0] // self.slot_ms

    def store(self, kept: DataFrame, batch_id: int, back: DataFrame | None = None, now_ms: int | None = None) -> None:
        """``now_ms``: the instant of the batch (default: now)."""
        at = F.lit(self.now_ms() if now_ms is None else now_ms) if self.arrival else F.col("ts")

        def count(clicks: DataFrame) -> DataFrame:
            return ads.pane_counts(clicks, self.slot_ms, at).where(self.live())

        self.slots.write(less(count, kept, back), batch_id)

    def trend_at(self, spark: SparkSession, end_ms: int) -> DataFrame:
        """The per-ad minute JSON of the hour of slots ending at ``end_ms``."""
        lo, hi = ads.last_hour_bounds(end_ms, self.span_ms, self.slot_ms)
        cur = self.slots.current(spark)
        cur = cur.where((F.col("slot") >= lo // self.slot_ms) & (F.col("slot") < hi // self.slot_ms))
        return ads.minutes_json(cur.groupBy("ads_id", "hm").agg(F.sum("cnt").cast("long").alias("cnt")))

    def trend_slides(self, spark: SparkSession, lo_ms: int, hi_ms: int) -> DataFrame:
        """The trend at every slide that ends in [lo_ms, hi_ms), from the slots still kept."""
        return ads.slides_json(ads.slide_minutes(self.slots.current(spark), lo_ms, hi_ms, self.span_ms, self.slot_ms))

    def publish(self, spark: SparkSession, end_ms: int | None = None) -> None:
        """Store the trend as of now; an hour without clicks stores an empty one."""
        with self._one:  # batches and the timer publish from different threads
            version = self.published.last(spark) + 1
            self.trend.write(self.trend_at(spark, self.now_ms() if end_ms is None else end_ms), version)
            self.published.commit(spark, version)
            self.trend.tidy(spark, version)

    def current_trend(self, spark: SparkSession) -> DataFrame:
        """The trend published last."""
        return self.trend.current(spark)

    def trend_hash(self, spark: SparkSession) -> DataFrame:
        """R8 as (key, field, value) rows of the original layout."""
        return hashview.last_hour_hash(self.current_trend(spark))
