"""R6 with the running count kept by the engine.

``groupBy().count()`` on the stream holds one count per (day, area, city, ad) in the state
store, which survives restarts in the checkpoint. In ``update`` mode a micro-batch hands
on the absolute counts of the keys it changed; they are upserted into a keyed table as
the batch's version, where the newest count of a key is the one that holds. A batch that
is run again gets the same counts from the state and overwrites its version.

Like the original the state never forgets. With ``keep_days`` it does: counts are then
grouped by day windows under a watermark, days older than that leave the state and
clicks later than that are dropped (days must be whole in the session time zone, UTC).

The application (:mod:`clickpulse.streaming.app`) sums increments instead, which lets a
click be taken back; this form is for counts alone, where the stream's own state is enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.functions.timefmt import day_string, ms_to_ts
from clickpulse.operators import ads
from clickpulse.sources.streams import with_trigger
from clickpulse.sources.versions import CommitLog, VersionedTable
from clickpulse.streaming.counts import DAY_AREA_CITY_ADS

_KEYS = ["day", "area", "city", "ads_id"]


def running_counts(clicks: DataFrame, keep_days: int | None = None) -> DataFrame:
    """The running count per (day, area, city, ad) of a stream of clicks."""
    if keep_days is None:
        return clicks.groupBy(day_string(F.col("ts")).alias("day"), "area", "city", "ads_id") \
            .agg(F.count(F.lit(1)).alias("cnt"))
    timed = clicks.withColumn("at", ms_to_ts(F.col("ts"))).withWatermark("at", f"{int(keep_days)} days")
    counts = timed.groupBy(F.window("at", "1 day"), "area", "city", "ads_id").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "area", "city", "ads_id", "cnt")


class RunningCounts:
    """The keyed table of running counts and the query that fills it."""

    def __init__(self, base_dir: str, keep_days: int | None = None, compact_every: int = 10, buckets: int = 16):
        self.base_dir, self.keep_days = base_dir.rstrip("/"), keep_days
        self.log = CommitLog(f"{self.base_dir}/commits")
        self.table = VersionedTable(f"{self.base_dir}/day_area_city_ads", DAY_AREA_CITY_ADS, self.log, "latest",
                                    _KEYS, ["day"], compact_every, buckets)

    def upsert(self, changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        if batch_id <= self.log.last(spark):
            return
        self.table.write(changed, batch_id)
        self.log.commit(spark, batch_id)
        self.table.tidy(spark, batch_id)

    def start(self, lines: DataFrame, available_now: bool = False) -> StreamingQuery:
        """Count the good lines of a stream of ad-log text."""
        counts = running_counts(ads.good_lines(ads.parse_ad_lines(lines)), self.keep_days)
        w = counts.writeStream.outputMode("update").foreachBatch(self.upsert)
        return with_trigger(w.option("checkpointLocation", f"{self.base_dir}/checkpoint"), available_now).start()

    def current(self, spark: SparkSession) -> DataFrame:
        """The counts as of the last finished batch."""
        return self.table.current(spark)
