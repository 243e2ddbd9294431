"""Two-pass external shuffle into shards (op8), native DataFrame operations only.

Pass 1 scatters records uniformly by a seeded hash of the row into buckets that
fit in memory; pass 2 holds one bucket at a time as an array, brings it into a
fixed order, applies the Fisher-Yates shuffle (``functions.shuffle``, seeded) and
writes it to the shared scratch folder. Shards deal the written records out in
turn: record number p (bucket offset + place in the bucket) goes to shard
p mod n, slot p div n, so shard counts differ by one at most (law ``rows``).

The hash takes in the row's place in its input partition, so copies of a row and
rows with an equal or null id spread like any others. A null text counts as
empty for sizes and checksums. Extra columns travel along. An empty table gives
an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickpulse.llm.common import written

BUCKET_BYTES = 24 << 20  # text bytes aimed at in one bucket
SEED = 20240607


def permuted(docs: DataFrame, text_col: str = "text", seed: int = SEED,
             bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(record, bucket, place): every row of ``docs`` as a struct, its bucket and random place there."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(64))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    placed = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("record"))
    scattered = placed.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(buckets))) \
        .repartition(buckets, "bucket")
    held = scattered.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("row", "record"))).alias("held"))
    shuffled = held.select("bucket", F.shuffle("held", seed).alias("held"))
    return written(shuffled.select("bucket", F.posexplode("held").alias("place", "item"))
                   .select("bucket", "place", "item.record"), "shuffled")


def positions(rows: DataFrame) -> DataFrame:
    """``rows`` with (bucket, place) replaced by ``position``, counted through all buckets from 0.

    The join with the buckets' offsets moves ``rows``: pass no more columns than are needed.
    """
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return rows.join(offsets, "bucket").withColumn("position", F.col("offset") + F.col("place")) \
        .drop("bucket", "place", "offset")


def shuffle_records(docs: DataFrame, text_col: str = "text", seed: int = SEED,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Struct column ``record`` with every row of ``docs``, and its random ``position`` from 0."""
    return positions(permuted(docs, text_col, seed, bucket_bytes))


def dealt(rows: DataFrame, n: int = 8) -> DataFrame:
    """``rows`` with ``position`` replaced by shard and gapless slot."""
    return rows.withColumn("shard", F.pmod("position", F.lit(n)).cast("int")) \
        .withColumn("slot", F.floor(F.col("position") / n).cast("long")).drop("position")


def shards(docs: DataFrame, n: int = 8, text_col: str = "text", seed: int = SEED,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` as ``record``, each with its shard and gapless slot."""
    return dealt(shuffle_records(docs, text_col, seed, bucket_bytes), n)


def write_shards(docs: DataFrame, path: str, n: int = 8, **options) -> None:
    """One folder per shard (``shard=k``) of Parquet files, rows in slot order."""
    shards(docs, n, **options).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .select("record.*", "slot", "shard").write.partitionBy("shard").parquet(path)
