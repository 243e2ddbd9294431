"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes, merges
# small shuffle partitions and splits skewed ones; the time zone pins the
# text forms of dates and minutes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no Python call-site capture per Column (it only feeds error messages and
    # costs a gateway round trip for every function call while building plans)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # stream state off-heap in RocksDB with changelog checkpoints: per-user
    # blacklist state and running counts can outgrow executor heaps
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Sizing for a large cluster (100 TB of input): ~256 MB file splits and
# shuffle partitions, many initial shuffle partitions that AQE coalesces.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
}

# A micro-batch of a few seconds is small next to the batch inputs.
STREAM_PARTITIONS = 200


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "clickpulse", extra: dict | None = None,
                cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with :data:`BASE_CONF` applied.

    On a cluster leave ``master`` unset and pass ``cluster=True`` (adds
    :data:`CLUSTER_CONF`), or size ``shuffle_partitions`` to the data (about
    128-256 MB of shuffle per partition); locally use the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    try:  # classic sessions; Spark Connect has no SparkContext
        sc = spark.sparkContext
        found = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
        if found:
            return found
    except Exception:  # noqa: BLE001
        pass
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # noqa: BLE001
        return None


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in a fresh scratch folder and read back.

    Cuts the lineage like a checkpoint, and later reads still prune columns and
    push filters.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    State tables, replayed stream sources and lineage cuts are written here.
    Only on a local master may the setting be absent: a local folder is then
    made and registered. On a cluster its executors could not see that folder.
    """
    base = _checkpoint_dir(spark)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not re.match(r"local($|\[)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        base = tempfile.mkdtemp(prefix="clickpulse-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(base)
            base = _checkpoint_dir(spark) or base
        except Exception:  # noqa: BLE001 - Spark Connect: keep the local folder
            pass
    sub = f"{name or 'run'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub
