"""Replays of the stream jobs over the driver's tables.

The ad clicks of the tables are written as text lines (the stream's wire format)
slice by slice into a fresh folder under the shared scratch dir. After each slice
the query is started from its checkpoint, drains what is new and stops, so a
replay crosses ``SLICES`` micro-batches at least, each after a restart; with
``compact_every=3`` the tables are folded twice on the way. Slices follow the
event time, or (``unordered``) a hash, so that every batch holds late clicks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators import ads
from clickpulse.plans.params import BLACKLIST_THRESHOLD, LAST_HOUR_END_MS, LAST_HOUR_SLOT_MS, SLOT_MS
from clickpulse.session import scratch_dir
from clickpulse.sources.fixtures import MallTables
from clickpulse.sources.streams import text_lines
from clickpulse.streaming import running
from clickpulse.streaming.app import Realtime, start_realtime

SLICES = 7
BUCKETS = 2  # a replay's tables are small


def slices(clicks: DataFrame, n: int = SLICES, unordered: bool = False) -> list[DataFrame]:
    """``clicks`` cut into ``n`` parts by event time, or by a hash of the click."""
    if unordered:
        part = F.pmod(F.xxhash64(*clicks.columns), F.lit(n))
        return [clicks.where(part == i) for i in range(n)]
    lo, hi = clicks.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return [clicks]
    step = (hi - lo) // n + 1
    return [clicks.where((F.col("ts") >= lo + i * step) & (F.col("ts") < lo + (i + 1) * step)) for i in range(n)]


def replay(spark: SparkSession, parts: list[DataFrame], jobs: tuple[str, ...], threshold: int = BLACKLIST_THRESHOLD,
           slot_ms: int = SLOT_MS, now_ms: int = LAST_HOUR_END_MS + 60 * 86_400_000, name: str = "replay",
           **options) -> Realtime:
    """Run ``jobs`` over lists of clicks, a restart of the query after each."""
    base = scratch_dir(spark, name)
    rt = None
    for i, part in enumerate(parts):
        ads.to_lines(part).write.text(f"{base}/src/part={i:04d}")
        rt = start_realtime(spark, text_lines(spark, f"{base}/src"), f"{base}/run", threshold, available_now=True,
                            slot_ms=slot_ms, now_ms=lambda: now_ms, compact_every=3, jobs=jobs, **{"buckets": BUCKETS, **options})
        rt.await_all()
    return rt


def _parts(spark: SparkSession, sf_dir: str, unordered: bool = False) -> list[DataFrame]:
    return slices(MallTables(spark, sf_dir).ads(), unordered=unordered)


def blacklist(spark: SparkSession, sf_dir: str, keep_clicks: bool = False, unordered: bool = False) -> Realtime:
    return replay(spark, _parts(spark, sf_dir, unordered), ("R5",), keep_clicks=keep_clicks, name="stream-blacklist")


def day_area(spark: SparkSession, sf_dir: str, unordered: bool = False) -> Realtime:
    return replay(spark, _parts(spark, sf_dir, unordered), ("R6",), name="stream-day-area")


def last_hour(spark: SparkSession, sf_dir: str) -> Realtime:
    # the clock stands at the trend's end: clicks after it are not read by the trend
    return replay(spark, _parts(spark, sf_dir), ("R8",), now_ms=LAST_HOUR_END_MS, max_ahead_ms=60 * 86_400_000,
                  trend_slot_ms=LAST_HOUR_SLOT_MS, name="stream-last-hour")


def running_counts(spark: SparkSession, sf_dir: str, unordered: bool = True) -> running.RunningCounts:
    """R6 with the engine's own state, a restart after each slice."""
    base = scratch_dir(spark, "stream-running")
    table = None
    for i, part in enumerate(_parts(spark, sf_dir, unordered)):
        ads.to_lines(part).write.text(f"{base}/src/part={i:04d}")
        table = running.RunningCounts(f"{base}/run", compact_every=3, buckets=BUCKETS)
        table.start(text_lines(spark, f"{base}/src"), available_now=True).awaitTermination()
    return table
