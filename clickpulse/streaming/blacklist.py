"""R5 on a stream: filter blacklisted users, count, flag.

One call per micro-batch, DataFrame operations only:

1. drop the clicks of listed users after their flagging slot (J3, a join with the
   list; AQE broadcasts it while it is small);
2. count the rest per (user, day, ad, slot) and put them beside the slots counted
   before for just those keys. Running sums over the slots give each user's first slot
   at which a count reaches the threshold (T6) -- wherever in time the new clicks lie;
3. list the users found, drop their clicks after that slot (T7: the flagging slot still
   passes) and write the kept clicks' counts as increments of the counter table.

The counters keep their slots, so the list does not depend on the order in which
clicks come: a late click is counted in its own slot, and a slot that is completed late
moves the user's flag to the earlier instant. Clicks that had passed after that instant
are then taken back (:meth:`Blacklist.step` returns them) from the kept clicks and the
running counts; this needs ``keep_clicks``. After any order of arrival list, counters and
kept clicks are those of the batch form. A flag only ever moves to an earlier slot, so a
dropped click never comes back.

List and tables are bucketed by user: a batch opens the buckets of its users only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.functions.timefmt import slot
from clickpulse.operators import ads
from clickpulse.sources.schemas import ADS_INFO
from clickpulse.sources.versions import CommitLog, VersionedTable

FLAGS = T.StructType([T.StructField("user_id", T.StringType()),
                      T.StructField("flag_slot", T.LongType())])
COUNTERS = T.StructType([T.StructField("day", T.StringType()), T.StructField("user_id", T.StringType()),
                         T.StructField("ads_id", T.StringType()), T.StructField("slot", T.LongType()),
                         T.StructField("n", T.LongType())])
_GROUP = ["day", "user_id", "ads_id"]
PAST = -(1 << 62)  # by arrival: the slot of everything before the batch at hand


class Blacklist:
    """The blacklist, its counters and (``keep_clicks``) the clicks it lets through.

    The slot of a click is its event-time slice of ``slot_ms``, or with
    ``arrival`` the micro-batch itself (its id), as in the original: a flag then
    takes effect from the next batch, nothing comes late and nothing is taken back.
    """

    def __init__(self, path: str, log: CommitLog, threshold: int, slot_ms: int, arrival: bool = False,
                 keep_clicks: bool = False, compact_every: int = 10, buckets: int = 16):
        self.threshold, self.slot_ms, self.arrival = threshold, slot_ms, arrival
        by = dict(bucket_by=["user_id"], compact_every=compact_every, buckets=buckets)
        self.flags = VersionedTable(f"{path}/blacklist", FLAGS, log, "min", ["user_id"], **by)
        self.counters = VersionedTable(f"{path}/counters", COUNTERS, log, "sum", [*_GROUP, "slot"], **by)
        self.kept = VersionedTable(f"{path}/kept", ADS_INFO, log, "log", **by) if keep_clicks else None

    def tables(self) -> list[VersionedTable]:
        return [t for t in (self.flags, self.counters, self.kept) if t is not None]

    def _slot(self, batch_id: int):
        return F.lit(batch_id).cast("long") if self.arrival else slot(F.col("ts"), self.slot_ms)

    def step(self, clicks: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame | None]:
        """Process one batch: (kept clicks, earlier kept clicks taken back or None).

        Persist the kept clicks, they are read again.
        """
        spark = clicks.sparkSession
        at = self._slot(batch_id)
        users = clicks.select("user_id").distinct()
        touched = self.flags.buckets_of(users)  # of all tables here, they are bucketed alike
        listed = self.flags.current(spark, batch_id - 1, only=users, buckets=touched)
        passed = ads.kept_clicks(clicks, listed, at)
        counts = ads.slot_counts(passed, at)
        held = self.counters.current(spark, batch_id - 1, only=counts.select(*_GROUP).distinct(),
                                     buckets=touched)
        both = counts.unionByName(held).groupBy("user_id", "day", "ads_id", "slot").agg(F.sum("n").alias("n"))
        found = ads.flag_users(both, self.threshold)
        old = listed.withColumnRenamed("flag_slot", "old_slot")
        found = found.join(old, "user_id", "left").where(F.col("old_slot").isNull() |
                                                         (F.col("flag_slot") < F.col("old_slot")))
        seen = Observation()
        self.flags.write(found, batch_id, seen, F.count(F.lit(1)).alias("n"))
        if not seen.get.get("n"):
            return passed, None
        # read back what was written: the flags are computed once
        fresh = self.flags._read(spark, [self.flags.version_path(batch_id)]).select(*FLAGS.names)
        kept = ads.kept_clicks(passed, fresh, at)
        if self.kept is None or self.arrival:
            return kept, None
        before = self.kept.current(spark, batch_id - 1, only=fresh.select("user_id"))
        back = before.join(fresh.join(old, "user_id", "left"), "user_id") \
            .where((at > F.col("flag_slot")) & (F.col("old_slot").isNull() | (at <= F.col("old_slot"))))
        return kept, back.select(*ADS_INFO.names)

    def store(self, kept: DataFrame, batch_id: int) -> int:
        """Write the kept clicks and their counts; returns how many there are."""
        at = F.lit(PAST).cast("long") if self.arrival else self._slot(batch_id)
        seen = Observation()
        self.counters.write(ads.slot_counts(kept, at), batch_id, seen, F.sum("n").alias("n"))
        if self.kept is not None:
            self.kept.write(kept, batch_id)
        return seen.get.get("n") or 0

    # ------------------------------------------------------------ results
    def current_blacklist(self, spark: SparkSession) -> DataFrame:
        """S11 read: the committed blacklist."""
        return self.flags.current(spark)

    def current_counters(self, spark: SparkSession) -> DataFrame:
        """S12 read: kept clicks per (day, user, ad)."""
        counts = self.counters.current(spark)
        if not self.arrival:
            counts = counts.join(self.current_blacklist(spark), "user_id", "left") \
                .where(F.col("flag_slot").isNull() | (F.col("slot") <= F.col("flag_slot")))
        return counts.groupBy(*_GROUP).agg(F.sum("n").cast("long").alias("cnt"))

    def kept_clicks(self, spark: SparkSession) -> DataFrame:
        """Every kept click of the committed batches, by the list as it is now."""
        kept = self.kept.current(spark)
        return kept if self.arrival else ads.kept_clicks(kept, self.current_blacklist(spark), self.slot_ms)
