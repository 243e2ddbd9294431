"""The realtime application: ad-log lines -> blacklist -> running counts and trend.

One streaming query wires the jobs the way the original main does, R5 and then
R6, R7 and R8 on the clicks it lets through:

    lines --parse--> rejects
               +---> Blacklist (R5) --kept--> DayArea (R6, R7), LastHour (R8)

All tables of a micro-batch are written under its batch id and committed together;
a batch that failed in the middle is run again and overwrites its own versions, a
batch that was committed does nothing. So each click is counted once: in the kept
clicks, among the listed users' dropped clicks, or in the rejects. Per batch these
numbers are stored, and they add up to the lines read; clicks taken back by a flag that
moves are stored beside them. They are observed on the batch's own writes, without jobs
of their own.

The clock is the wall clock or an injected one (replays), never the largest
timestamp seen. Lines that claim to come from more than ``max_ahead_ms`` after it
are rejected; late lines count in their own day. A batch keeps the instant of its first
attempt, so one that is run again judges its lines alike.

``base_dir`` holds the tables and the query's checkpoint; on a cluster it must be
shared storage (for example under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickpulse.operators import ads
from clickpulse.sources.streams import BATCH_INTERVAL, with_trigger
from clickpulse.sources.versions import BatchClock, CommitLog, VersionedTable
from clickpulse.streaming.blacklist import Blacklist
from clickpulse.streaming.counts import DayArea, LastHour

REJECTS = T.StructType([T.StructField("line", T.StringType()), T.StructField("_error", T.StringType())])
TOTALS = T.StructType([T.StructField(n, T.LongType()) for n in
                       ("batch_id", "lines", "kept", "blacklisted", "rejected", "taken_back")])
DAY_MS = 86_400_000


def together(spark: SparkSession, *steps: Callable) -> list:
    """Results of independent steps run at the same time: a small batch is mostly waiting for its jobs."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(s)) for s in steps]]


class RealtimeBatch:
    """The ``foreachBatch`` function of the application (see module doc).

    ``blacklist``, ``day_area`` and ``last_hour`` may each be None: replays of one
    job leave the others out.
    """

    def __init__(self, base_dir: str, log: CommitLog, blacklist: Blacklist | None, day_area: DayArea | None,
                 last_hour: LastHour | None, now_ms: Callable[[], int], max_ahead_ms: int = DAY_MS,
                 compact_every: int = 10):
        self.log, self.blacklist, self.day_area, self.last_hour = log, blacklist, day_area, last_hour
        self.now_ms, self.max_ahead_ms = now_ms, max_ahead_ms
        self.clock = BatchClock(f"{base_dir}/clocks")
        self.rejects = VersionedTable(f"{base_dir}/rejects", REJECTS, log, "log", compact_every=compact_every)
        self.totals = VersionedTable(f"{base_dir}/totals", TOTALS, log, "log", compact_every=compact_every)

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        if batch_id <= self.log.last(spark):
            return
        now = self.clock.at(spark, batch_id, self.now_ms())
        parsed = ads.parse_ad_lines(lines, latest_ms=now + self.max_ahead_ms).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._run(spark, parsed, int(batch_id), now)
        finally:
            parsed.unpersist()
        self.log.commit(spark, batch_id)
        tables = [t for step in (self.blacklist, self.day_area) if step is not None for t in step.tables()]
        last_steps = [lambda t=t: t.tidy(spark, batch_id) for t in [*tables, self.rejects, self.totals]]
        if self.last_hour is not None:
            last_steps += [lambda: self.last_hour.publish(spark),
                           lambda: self.last_hour.slots.tidy(spark, batch_id, self.last_hour.live())]
        together(spark, *last_steps)

    def _run(self, spark: SparkSession, parsed: DataFrame, batch_id: int, now: int) -> None:
        seen = Observation()
        read = parsed.observe(seen, F.count(F.lit(1)).alias("lines"), F.count("_error").alias("rejected"))
        clicks = ads.good_lines(parsed)
        step = self.blacklist.step if self.blacklist is not None else lambda clicks, _: (clicks, None)
        # rejects are written when there are none too: an earlier attempt may have left some
        _, (kept, back) = together(spark, lambda: self.rejects.write(ads.bad_lines(read), batch_id),
                                   lambda: step(clicks, batch_id))
        lines, rejected = seen.get.get("lines") or 0, seen.get.get("rejected") or 0
        kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
        back = back.persist(StorageLevel.MEMORY_AND_DISK) if back is not None else None
        try:
            n, taken, _, _ = together(
                spark,
                lambda: self.blacklist.store(kept, batch_id) if self.blacklist is not None else lines - rejected,
                lambda: back.count() if back is not None else 0,
                lambda: self.day_area and self.day_area.store(kept, batch_id, back),
                lambda: self.last_hour and self.last_hour.store(kept, batch_id, back, now))
        finally:
            kept.unpersist()
            if back is not None:
                back.unpersist()
        row = (batch_id, lines, n, lines - rejected - n, rejected, taken)
        self.totals.write(spark.createDataFrame([row], TOTALS), batch_id)


@dataclass
class Realtime:
    """The running application: its batch function and its streaming queries."""

    base_dir: str
    batch: RealtimeBatch
    queries: list[StreamingQuery] = field(default_factory=list)

    @property
    def blacklist(self) -> Blacklist | None:
        return self.batch.blacklist

    @property
    def day_area(self) -> DayArea | None:
        return self.batch.day_area

    @property
    def last_hour(self) -> LastHour | None:
        return self.batch.last_hour

    def rejects(self, spark: SparkSession) -> DataFrame:
        return self.batch.rejects.current(spark)

    def totals(self, spark: SparkSession) -> DataFrame:
        """Per batch: lines = kept + blacklisted + rejected, and the earlier kept clicks taken back."""
        return self.batch.totals.current(spark)

    def await_all(self) -> None:
        for q in self.queries:
            q.awaitTermination()


def realtime_tables(base_dir: str, threshold: int, slot_ms: int = 5_000, now_ms: Callable[[], int] | None = None,
                    compact_every: int = 10, trend_by: str = "event", slots_by: str = "event",
                    max_ahead_ms: int = DAY_MS, keep_clicks: bool = False, trend_slot_ms: int = 5_000,
                    jobs: tuple[str, ...] = ("R5", "R6", "R8"), buckets: int = 16) -> Realtime:
    """The application's tables under ``base_dir``, without a running query (readers use this too).

    ``buckets``: folders by key in each version of the keyed tables; the same for as long as they live.
    """
    base = base_dir.rstrip("/")
    clock = now_ms or (lambda: int(time.time() * 1000))
    log = CommitLog(f"{base}/commits")
    return Realtime(base, RealtimeBatch(
        base, log,
        Blacklist(f"{base}/blacklist", log, threshold, slot_ms, slots_by == "arrival", keep_clicks, compact_every,
                  buckets)
        if "R5" in jobs else None,
        DayArea(f"{base}/day_area", log, compact_every=compact_every, buckets=buckets) if "R6" in jobs else None,
        LastHour(f"{base}/last_hour", log, trend_slot_ms, arrival=trend_by == "arrival", compact_every=compact_every,
                 now_ms=clock) if "R8" in jobs else None,
        clock, max_ahead_ms, compact_every))


def start_realtime(spark: SparkSession, lines: DataFrame, base_dir: str, threshold: int,
                   available_now: bool = False, **options) -> Realtime:
    """Start the query (``available_now``: drain what is there and stop).

    ``options`` are those of :func:`realtime_tables`. ``trend_by="arrival"``
    windows the last-hour trend by arrival and ``slots_by="arrival"`` makes each
    micro-batch one blacklist slot, as in the original; the default is event time.
    """
    rt = realtime_tables(base_dir, threshold, **options)
    w = lines.writeStream.foreachBatch(rt.batch).option("checkpointLocation", f"{rt.base_dir}/checkpoint")
    rt.queries.append(with_trigger(w, available_now).start())
    if rt.last_hour is not None and not available_now:
        rt.queries.append(start_trend_timer(spark, rt.last_hour, f"{rt.base_dir}/timer"))
    return rt


def start_trend_timer(spark: SparkSession, last_hour: LastHour, checkpoint: str,
                      interval: str = BATCH_INTERVAL) -> StreamingQuery:
    """Publish the trend every ``interval`` whether clicks come or not."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    w = ticks.writeStream.foreachBatch(lambda df, _: last_hour.publish(df.sparkSession))
    return with_trigger(w.option("checkpointLocation", checkpoint), False, interval).start()
