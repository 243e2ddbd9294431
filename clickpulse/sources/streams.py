"""Stream sources of ad-log lines (S3) and trigger choices.

Both sources yield one string column ``value`` per log line, so the parse
step (:func:`clickpulse.operators.ads.parse_ad_lines`) is shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

BATCH_INTERVAL = "5 seconds"


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str,
                starting_offsets: str = "latest", group_id: str | None = None,
                max_offsets_per_trigger: int | None = None, extra: dict | None = None) -> DataFrame:
    """S3: subscribe to one topic, newest offsets first; offsets live in the checkpoint.

    ``group_id`` names the consumer group (for monitoring; progress is the
    checkpoint's), ``max_offsets_per_trigger`` bounds each micro-batch.
    Needs the ``spark-sql-kafka`` connector on the classpath; without it Spark
    raises when the query is defined.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(value AS STRING) AS value")


def text_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stand-in for the topic: each new text file under ``path`` is a batch of lines."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def with_trigger(writer: DataStreamWriter, available_now: bool = False,
                 interval: str = BATCH_INTERVAL) -> DataStreamWriter:
    """Fixed micro-batch interval, or drain what is there and stop (replays, tests)."""
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
