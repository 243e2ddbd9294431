"""JDBC result sinks.

Spark's JDBC writer opens one connection per partition on the executors
and inserts in batches, so the original connection pool and driver-side
statement loops are not needed. Coalesce wide results first so a database
does not see thousands of parallel writers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter


@dataclass
class JdbcTarget:
    """Where and how to write: URL, credentials, driver, batch size, parallel writers."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    batch_size: int = 1000
    max_writers: int | None = 8
    extra: dict = field(default_factory=dict)

    def properties(self) -> dict:
        p = {"batchsize": str(self.batch_size), **self.extra}
        if self.user is not None:
            p["user"] = self.user
        if self.password is not None:
            p["password"] = self.password
        if self.driver:
            p["driver"] = self.driver
        return p


def _writer(df: DataFrame, target: JdbcTarget, mode: str, truncate: bool) -> DataFrameWriter:
    if target.max_writers:
        df = df.coalesce(target.max_writers)
    w = df.write.mode(mode)
    if truncate:
        w = w.option("truncate", "true")
    return w


def overwrite(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Replace the table (dropped and recreated from the DataFrame schema)."""
    _writer(df, target, "overwrite", truncate=False).jdbc(target.url, table, properties=target.properties())


def truncate_insert(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Empty the table but keep its definition, then insert (per partition)."""
    _writer(df, target, "overwrite", truncate=True).jdbc(target.url, table, properties=target.properties())


def append(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Add rows; runs are told apart by their ``task_id`` column."""
    _writer(df, target, "append", truncate=False).jdbc(target.url, table, properties=target.properties())


# Write modes by name, for jobs that choose per result.
WRITERS = {"overwrite": overwrite, "truncate_insert": truncate_insert, "append": append}
