"""Catalog tables (S1, S2) and the reference table set read from a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.sources.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION, decode


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table (``db.table`` or a name in the current database)."""
    return spark.table(name)


def save_table(df: DataFrame, name: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Replace ``name`` as a managed table (drop-if-exists + create in one step), or ``append`` to it.

    ``partition_by=["date"]`` lays the clickstream out by day, which turns the
    date bound of the condition filter into partition pruning.
    """
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, mode: str = "overwrite") -> None:
    """S2 with ``buckets`` hash buckets by ``keys``, sorted inside: equal keys lie in equal buckets of
    every table saved alike, so joins and groupings on the keys need no shuffle.

    The rows are dealt to the buckets first, so a bucket is one file and not one per task.
    """
    (df.repartition(buckets, *keys).write.mode(mode).format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def create_database(spark: SparkSession, name: str, location: str) -> str:
    """Make sure that database ``name`` exists, its managed tables under the shared folder ``location``."""
    quoted = location.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{quoted}'")
    return name


def save_mall(tables, database: str, buckets: int) -> None:
    """The four tables of ``tables`` saved in a database; visits and users bucketed by user."""
    save_bucketed(tables.visits(), f"{database}.user_visit_action", ["user_id"], buckets)
    save_bucketed(tables.users(), f"{database}.user_info", ["user_id"], buckets)
    save_table(tables.cities(), f"{database}.city_info")
    save_table(tables.products(), f"{database}.product_info")


class CatalogTables:
    """The four mall tables from a catalog database, typed-decoded."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark = spark
        self.prefix = f"{database}." if database else ""

    def _t(self, name: str, schema) -> DataFrame:
        return decode(read_table(self.spark, self.prefix + name), schema)

    def visits(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Visits; the text bounds on ``date`` (inclusive) reach the scan as they are."""
        v = self._t("user_visit_action", USER_VISIT_ACTION)
        v = v if start is None else v.where(F.col("date") >= F.lit(start))
        return v if end is None else v.where(F.col("date") <= F.lit(end))

    def users(self) -> DataFrame:
        return self._t("user_info", USER_INFO)

    def cities(self) -> DataFrame:
        return self._t("city_info", CITY_INFO)

    def products(self) -> DataFrame:
        return self._t("product_info", PRODUCT_INFO)
