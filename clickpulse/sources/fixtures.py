"""Reference-shaped inputs derived from the driver's parquet tables.

``events`` becomes the click stream (``user_visit_action`` and the ad log),
``customer`` the users, ``nation`` x ``region`` the cities and ``part`` the
products. Every view is a lazy projection of a parquet scan, so Catalyst
prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickpulse.sources.schemas import (
    CITY_INFO,
    PRODUCT_INFO,
    USER_INFO,
    USER_VISIT_ACTION,
    decode,
)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Declared schemas of the driver tables this package reads: no footer
# inference on every read, and a wrong file fails loudly at the scan.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (declared schema when known)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


# The mapping, as Spark SQL expressions over the driver's tables. One
# ``selectExpr`` per view keeps plan construction to a single parse.
_K = "CAST(get_json_object(props, '$.k') AS BIGINT)"
_DAY = "date_format(ts, 'yyyy-MM-dd')"
_CATS = "CASE WHEN k % 3 = 0 THEN CAST(k % 20 + 1 AS STRING) ELSE concat_ws(',', k % 20 + 1, (k + 7) % 20 + 1) END"
_PRODS = "concat_ws(',', event_id % 200, (event_id + 11) % 200)"
_IS_CLICK = "event_type IN ('click', 'view')"

VISIT_EXPRS = [
    f"{_DAY} AS date",
    "user_id",
    f"concat(CAST(user_id AS STRING), '-', {_DAY}) AS session_id",
    "k % 10 + 1 AS page_id",
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS action_time",
    "CASE WHEN event_type = 'error' THEN concat('kw_', k % 6) END AS search_keyword",
    f"CASE WHEN {_IS_CLICK} THEN k % 20 + 1 ELSE -1 END AS click_category_id",
    f"CASE WHEN {_IS_CLICK} THEN event_id % 200 ELSE -1 END AS click_product_id",
    f"CASE WHEN event_type = 'signup' THEN {_CATS} END AS order_category_ids",
    f"CASE WHEN event_type = 'signup' THEN {_PRODS} END AS order_product_ids",
    f"CASE WHEN event_type = 'purchase' THEN {_CATS} END AS pay_category_ids",
    f"CASE WHEN event_type = 'purchase' THEN {_PRODS} END AS pay_product_ids",
    "(event_id + k) % 25 AS city_id",
]

USER_EXPRS = [
    "c_custkey AS user_id",
    "concat('user_', CAST(c_custkey AS STRING)) AS username",
    "c_name AS name",
    "CAST(20 + c_custkey % 41 AS INT) AS age",
    "c_mktsegment AS professional",
    "CASE WHEN c_custkey % 10 < 6 THEN 'M' ELSE 'F' END AS gender",
]

PRODUCT_EXPRS = [
    "p_partkey AS product_id",
    "p_name AS product_name",
    "CASE WHEN p_partkey % 10 < 7 THEN 'self' ELSE 'third_party' END AS extend_info",
]

AD_EXPRS = [
    "unix_millis(CAST(ts AS TIMESTAMP)) AS ts",
    "area",
    "city_name AS city",
    "CAST(user_id % 30 + 101 AS STRING) AS user_id",
    "CAST(k % 5 + 1 AS STRING) AS ads_id",
]


def user_visit_action(spark: SparkSession, sf_dir: str, start: str | None = None,
                      end: str | None = None) -> DataFrame:
    """Visits; ``start`` and ``end`` (ISO dates, inclusive) bound the scanned ``events.ts``."""
    ev = read_table(spark, sf_dir, "events")
    if start:
        ev = ev.where(f"ts >= TIMESTAMP_NTZ '{start} 00:00:00'")
    if end:
        ev = ev.where(f"ts < TIMESTAMP_NTZ '{end} 00:00:00' + INTERVAL 1 DAY")
    ev = ev.selectExpr("*", f"{_K} AS k")
    return decode(ev.selectExpr(*VISIT_EXPRS), USER_VISIT_ACTION)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(read_table(spark, sf_dir, "customer").selectExpr(*USER_EXPRS), USER_INFO)


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    df = n.join(r, n.n_regionkey == r.r_regionkey).selectExpr(
        "n_nationkey AS city_id", "n_name AS city_name", "r_name AS area")
    return decode(df, CITY_INFO)


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(read_table(spark, sf_dir, "part").selectExpr(*PRODUCT_EXPRS), PRODUCT_INFO)


def ads_log(spark: SparkSession, sf_dir: str, lo_ms: int | None = None, hi_ms: int | None = None) -> DataFrame:
    """Ad clicks (ts ms, area, city, user_id, ads_id).

    ``lo_ms`` (inclusive) and ``hi_ms`` (exclusive) bound the scan of
    ``events.ts``, widened by two hours for clock changes of the session zone;
    the caller's own filter on ``ts`` stays exact.

    Each event joins exactly one city on ``(event_id + k) % 25``. No hint:
    the planner broadcasts the city table when its estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-checks with real
    sizes), else it shuffles both sides.
    """
    ev = read_table(spark, sf_dir, "events")
    slack = 2 * 3_600_000
    if lo_ms is not None:
        ev = ev.where(f"ts >= CAST(timestamp_millis({int(lo_ms) - slack}) AS TIMESTAMP_NTZ)")
    if hi_ms is not None:
        ev = ev.where(f"ts < CAST(timestamp_millis({int(hi_ms) + slack}) AS TIMESTAMP_NTZ)")
    ev = ev.selectExpr("event_id", "ts", "user_id", f"{_K} AS k")
    cities = city_info(spark, sf_dir)
    return ev.join(cities, (ev.event_id + ev.k) % 25 == cities.city_id).selectExpr(*AD_EXPRS)


@dataclass
class MallTables:
    """The four reference tables plus the ad log, built lazily from one folder."""

    spark: SparkSession
    sf_dir: str

    def visits(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return user_visit_action(self.spark, self.sf_dir, start, end)

    def users(self) -> DataFrame:
        return user_info(self.spark, self.sf_dir)

    def cities(self) -> DataFrame:
        return city_info(self.spark, self.sf_dir)

    def products(self) -> DataFrame:
        return product_info(self.spark, self.sf_dir)

    def ads(self, lo_ms: int | None = None, hi_ms: int | None = None) -> DataFrame:
        return ads_log(self.spark, self.sf_dir, lo_ms, hi_ms)

    def register_views(self) -> None:
        """Bind the reference table names as temp views for SQL users."""
        self.visits().createOrReplaceTempView("user_visit_action")
        self.users().createOrReplaceTempView("user_info")
        self.cities().createOrReplaceTempView("city_info")
        self.products().createOrReplaceTempView("product_info")
        self.ads().createOrReplaceTempView("ads_log")
