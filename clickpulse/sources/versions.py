"""Versioned Parquet tables: the sink and the state of the stream jobs.

A micro-batch writes each of its tables as ``<path>/data/v=<batch id>`` and then
commits the batch id in a :class:`CommitLog`. Readers see exactly the committed
versions; a batch that is run again overwrites what it had written, so every table
is idempotent. Kinds of tables:

* ``sum``: a version holds increments; the table is their sum per key. Late rows
  count whenever they come, and nothing depends on how the input was cut. Keys whose
  sums are all zero are gone.
* ``min``: the least value per key.
* ``latest``: per key group, the rows of the newest version that holds the group.
* ``whole``: the rows of the newest committed version, also when it is empty.
* ``log``: all rows.

Buckets. With ``bucket_by`` a version is laid out in folders ``bucket=<hash of these
keys>``, rows sorted by key inside. A read for given keys (``only``) opens the buckets
of those keys and no others; that list is at most ``buckets`` numbers long, whatever
the keys are.

Runs. Every ``compact_every`` versions those versions are merged into one run
``<path>/runs/r=<first>-<last>``; every ``compact_every`` squared versions the runs of
that stretch are merged into a longer one, and so on. A row is therefore rewritten once
per power of ``compact_every``, a merge rewrites only what its own stretch of versions
touched, and a read opens fewer than ``compact_every`` folders per power. What a run
replaces is removed at the next merge, for readers that planned on it; of a ``whole``
table the last ``KEEP_WHOLE`` versions stay.

What does not exist is looked up by name; any other read error is raised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "v"
BUCKET = "bucket"
KEEP_WHOLE = 60  # versions of a ``whole`` table: five minutes of a trend published every 5 s
SALT = 8         # a hot key's rows of a ``log`` are written by so many tasks


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; a folder that does not exist has none."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class CommitLog:
    """Finished batch ids, one empty file each; read anew at every call."""

    KEEP = 50

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def last(self, spark: SparkSession) -> int:
        return max((int(n) for n in names(spark, self.path) if n.isdigit()), default=-1)

    def commit(self, spark: SparkSession, version: int) -> None:
        fs, p = _fs(spark, f"{self.path}/{int(version)}")
        fs.create(p, True).close()
        for n in names(spark, self.path):
            if n.isdigit() and int(n) <= version - self.KEEP:
                remove(spark, f"{self.path}/{n}")


class BatchClock:
    """The instant at which a batch was first tried: a batch that is run again gets the same one."""

    KEEP = 50

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def at(self, spark: SparkSession, batch_id: int, now_ms: int) -> int:
        held = f"{self.path}/{int(batch_id)}"
        for n in names(spark, held):
            return int(n)
        fs, p = _fs(spark, f"{held}/{int(now_ms)}")
        fs.create(p, True).close()
        for n in names(spark, self.path):
            if n.isdigit() and int(n) <= batch_id - self.KEEP:
                remove(spark, f"{self.path}/{n}")
        return int(now_ms)


class VersionedTable:
    """One table of committed versions (see module doc)."""

    KINDS = ("sum", "min", "latest", "whole", "log")

    def __init__(self, path: str, schema: T.StructType, log: CommitLog, kind: str, keys: list[str] = (),
                 bucket_by: list[str] = (), compact_every: int = 10, buckets: int = 16):
        if kind not in self.KINDS:
            raise ValueError(f"kind must be one of {self.KINDS}: {kind}")
        self.path, self.schema, self.log, self.kind = path.rstrip("/"), schema, log, kind
        self.keys, self.bucket_by, self.buckets = list(keys), list(bucket_by), buckets
        self.compact_every = max(2, compact_every)

    # ------------------------------------------------------------ layout
    def version_path(self, version: int) -> str:
        return f"{self.path}/data/{VERSION}={int(version)}"

    def versions(self, spark: SparkSession) -> list[int]:
        """Version folders that exist."""
        return sorted(int(n[2:]) for n in names(spark, f"{self.path}/data") if n.startswith(f"{VERSION}="))

    def runs(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(first, last) version of every finished run."""
        found = [n for n in names(spark, f"{self.path}/runs") if n.startswith("r=")]
        return sorted(tuple(map(int, n[2:].split("-"))) for n in found
                      if exists(spark, f"{self.path}/runs/{n}/_SUCCESS"))

    def _parts(self, spark: SparkSession, upto: int) -> list[tuple[int, int, str]]:
        """The folders that together hold every version up to ``upto`` once."""
        held = [(a, b, f"{self.path}/runs/r={a}-{b}") for a, b in self.runs(spark) if b <= upto]
        held += [(v, v, self.version_path(v)) for v in self.versions(spark) if v <= upto]
        out, last = [], -1
        for a, b, path in sorted(held, key=lambda h: (h[0], -h[1])):
            if b > last:
                out.append((a, b, path))
                last = b
        return out

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    # ------------------------------------------------------------ write
    def _save(self, df: DataFrame, path: str, observation: Observation | None = None, *metrics: Column) -> None:
        if self.bucket_by:
            df = df.withColumn(BUCKET, self._bucket())
            salt = [F.pmod(F.hash(*self.schema.names), F.lit(SALT))] if self.kind == "log" else []
            df = df.repartition(BUCKET, *salt).sortWithinPartitions(BUCKET, *self.keys)
        if observation is not None:
            # on the rows as they are written, in the job's last stage: a task that is run again counts once
            df = df.observe(observation, *metrics)
        w = df.write.mode("overwrite")
        (w.partitionBy(BUCKET) if self.bucket_by else w).parquet(path)

    def write(self, df: DataFrame, version: int, observation: Observation | None = None, *metrics: Column) -> None:
        """The rows of ``version``, replacing what an unfinished run of it left.

        ``observation`` collects ``metrics`` of these rows while they are written.
        """
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields],
                         F.lit(int(version)).cast("long").alias(VERSION))
        self._save(rows, self.version_path(version), observation, *metrics)

    def tidy(self, spark: SparkSession, version: int, keep: Column | None = None) -> None:
        """After ``version`` is committed: merge its stretch of versions, remove what is superseded.

        ``keep`` limits the rows that a merge carries on; the table is then merged whole
        every time, which pays while few rows are kept.
        """
        if self.kind == "whole":
            for v in self.versions(spark):
                if v <= version - KEEP_WHOLE:
                    remove(spark, self.version_path(v))
            return
        n = span = version + 1
        if n % self.compact_every:
            return
        if keep is None:
            span = self.compact_every
            while n % (span * self.compact_every) == 0:
                span *= self.compact_every
        parts = self._parts(spark, version)
        live = {path for _, _, path in parts}
        for a, b in self.runs(spark):
            if b <= version and f"{self.path}/runs/r={a}-{b}" not in live:
                remove(spark, f"{self.path}/runs/r={a}-{b}")
        for v in self.versions(spark):
            if v <= version and self.version_path(v) not in live:
                remove(spark, self.version_path(v))
        parts = [p for p in parts if p[1] >= n - span]
        if len(parts) < 2 and keep is None:
            return
        rows = self._merged(self._read(spark, [p[2] for p in parts]))
        path = f"{self.path}/runs/r={parts[0][0]}-{version}"
        if path not in live:
            self._save(rows if keep is None else rows.where(keep), path)

    # ------------------------------------------------------------ read
    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())])
        # the folders are listed by name here; their names are no columns
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row per key (``sum``, ``min``) or the newest group (``latest``), with a version."""
        if self.kind == "log":
            return rows
        if self.kind == "latest":
            newest = rows.groupBy(*self.keys).agg(F.max(VERSION).alias(VERSION))
            return rows.join(newest, [*self.keys, VERSION], "left_semi").select(*rows.columns)
        values = [f for f in self.schema.fields if f.name not in self.keys]
        fold = F.sum if self.kind == "sum" else F.min
        out = rows.groupBy(*self.keys).agg(*[fold(f.name).cast(f.dataType).alias(f.name) for f in values],
                                           F.max(VERSION).alias(VERSION))
        if self.kind == "sum":
            some = F.lit(False)
            for f in values:
                some = some | (F.col(f.name) != 0)
            out = out.where(some)
        return out.select(*rows.columns)

    def buckets_of(self, only: DataFrame) -> list[int]:
        """The buckets of some keys, at most ``buckets`` numbers."""
        return [r[0] for r in only.select(self._bucket()).distinct().collect()]

    def folders(self, spark: SparkSession, upto: int | None = None, only: DataFrame | None = None,
                buckets: list[int] | None = None) -> list[str]:
        """The folders a read opens: with ``only`` (key columns) the buckets of those keys, or those given."""
        upto = self.log.last(spark) if upto is None else upto
        paths = [path for _, _, path in self._parts(spark, upto)]
        if only is None or not self.bucket_by or not set(self.bucket_by) <= set(only.columns):
            return paths
        wanted = {f"{BUCKET}={b}" for b in (self.buckets_of(only) if buckets is None else buckets)}
        return [f"{path}/{n}" for path in paths for n in names(spark, path) if n in wanted]

    def current(self, spark: SparkSession, upto: int | None = None, where: Column | None = None,
                only: DataFrame | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The table as of version ``upto`` (default: the last committed one).

        ``where`` and ``only`` (distinct key columns) limit the rows read before anything
        is summed; ``only`` also limits the buckets (``buckets``: if they are known already).
        """
        cols = self.schema.names
        upto = self.log.last(spark) if upto is None else upto
        if self.kind == "whole":
            held = [self.version_path(v) for v in self.versions(spark) if v == upto]
            return self._read(spark, held).select(*cols) if held else self.empty(spark)
        paths = self.folders(spark, upto, only, buckets)
        if not paths:
            return self.empty(spark)
        rows = self._read(spark, paths)
        if where is not None:
            rows = rows.where(where)
        if only is not None:
            rows = rows.join(only, only.columns, "left_semi")
        return self._merged(rows).select(*cols)
