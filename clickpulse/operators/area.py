"""Top products per area by clicks, with a city-share remark.

Plan: the click facts are first counted per (city_id, product_id) -- a
partial + final hash aggregate, so a hot product or city is combined map-side
and the shuffle carries at most one row per key and partition. Only those
counts meet the dimensions; the planner broadcasts a dimension when its size
estimate is under the broadcast threshold (AQE re-checks at run time) and
shuffles otherwise -- no unchecked hint. The
rest runs on aggregated rows: per (area, product, city), per (area, product),
and a ``rank`` per area that Spark cuts early with a partial WindowGroupLimit.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.text import join_text, percent, ratio

# Fixed values that must equal the original output:
# label of the remainder share in the city remark ("other"),
# the separator between remark entries, and the entry format "name:0.00%".
OTHER_LABEL = "其他"
REMARK_SEP = ", "


def product_click_counts(visits: DataFrame) -> DataFrame:
    """F4 + partial aggregate: product clicks per (city_id, product_id)."""
    return (visits.where(F.col("click_product_id") > -1)
            .groupBy("city_id", F.col("click_product_id").alias("product_id"))
            .agg(F.count(F.lit(1)).alias("n")))


def area_product_city_counts(visits: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """J2 + A6 input: clicks per (area, product_name, city_name).

    Equals ``count(*)`` over the inner star join of the raw rows, since each
    aggregated row meets the same dimension rows its facts would have met.
    Same-named products and cities merge.
    """
    counts = product_click_counts(visits)
    dims_city = cities.select("city_id", "city_name", "area")
    joined = (counts.join(dims_city, "city_id")
              .join(products.select("product_id", "product_name"), "product_id"))
    return (joined.groupBy("area", "product_name", "city_name")
            .agg(F.sum("n").alias("n")))


def city_remark(by_city: DataFrame, group_cols: list[str], city_col: str = "city_name",
                count_col: str = "n", top_n: int = 2) -> DataFrame:
    """Per group, the total count and the remark text.

    ``by_city`` holds one row per (group, city) with its count. The remark
    lists the ``top_n`` largest cities (ties by name) as ``name:0.00%`` of the
    group total; when the group has more than ``top_n`` cities an entry for
    the rest follows, ``1 - r1 - r2 ...`` folded left in double arithmetic.
    Built from native aggregates and one window over (group, city) rows --
    each window partition holds at most one row per city.
    """
    w = Window.partitionBy(*group_cols)
    city = F.coalesce(F.col(city_col).cast("string"), F.lit("null"))
    ranked = (by_city
              .withColumn("_rn", F.row_number().over(w.orderBy(F.desc(count_col), city)))
              .withColumn("_total", F.sum(count_col).over(w))
              .withColumn("_cities", F.count(F.lit(1)).over(w))
              .where(F.col("_rn") <= top_n)
              .withColumn("_ratio", ratio(F.col(count_col), F.col("_total")))
              .withColumn("_text", F.concat(city, F.lit(":"), percent(F.col("_ratio")))))
    grouped = ranked.groupBy(*group_cols).agg(
        F.first("_total").alias("click_count"),
        F.first("_cities").alias("_cities"),
        # at most top_n entries per group, sorted back into rank order
        F.array_sort(F.collect_list(F.struct("_rn", "_ratio", "_text"))).alias("_top"),
    )
    rest = F.aggregate(F.col("_top._ratio"), F.lit(1.0), lambda acc, r: acc - r)
    entries = F.when(
        F.col("_cities") > top_n,
        F.concat(F.col("_top._text"),
                 F.array(F.concat(F.lit(OTHER_LABEL + ":"), percent(rest)))),
    ).otherwise(F.col("_top._text"))
    return grouped.select(*group_cols, F.col("click_count").cast("long").alias("click_count"),
                          join_text(entries, REMARK_SEP).alias("city_remark"))


def city_remark_udf(top_n: int = 2):
    """U1 as a grouped aggregate over Arrow columns: ``city_remark(city_name, n)`` -> text.

    Feed it one row per (group, city) with its count, as :data:`AREA_REMARK_SQL` does: a
    group then holds at most one row per city, and counting keeps its partial aggregation.
    Cities listed twice are added up.
    """
    other, sep = OTHER_LABEL, REMARK_SEP

    @F.arrow_udf("string")
    def remark(city: pa.Array, n: pa.Array) -> str:
        t = pa.table({"city": pc.fill_null(pc.cast(city, pa.string()), "null"), "n": pc.cast(n, pa.int64())})
        t = t.group_by("city").aggregate([("n", "sum")]).sort_by([("n_sum", "descending"), ("city", "ascending")])
        names, counts = t["city"].to_pylist(), [x or 0 for x in t["n_sum"].to_pylist()]
        total = sum(counts)
        shares = [c / total if total else 0.0 for c in counts[:top_n]]
        entries = list(zip(names, shares))
        if len(names) > top_n:
            rest = 1.0
            for share in shares:
                rest -= share
            entries.append((other, rest))
        return sep.join(f"{name}:{share * 100:.2f}%" for name, share in entries)

    return remark


def register_city_remark(spark, name: str = "city_remark", top_n: int = 2) -> None:
    """Make ``city_remark(city_name, n)`` callable from SQL of this session."""
    spark.udf.register(name, city_remark_udf(top_n))


# A6 + A7 as SQL with the registered aggregate; counts per city come first.
AREA_REMARK_SQL = """
WITH clicks AS (
  SELECT city_id, click_product_id AS product_id, count(*) AS n
  FROM user_visit_action WHERE click_product_id > -1
  GROUP BY city_id, click_product_id),
by_city AS (
  SELECT c.area, p.product_name, c.city_name, sum(k.n) AS n
  FROM clicks k JOIN city_info c ON k.city_id = c.city_id
  JOIN product_info p ON k.product_id = p.product_id
  GROUP BY c.area, p.product_name, c.city_name),
totals AS (
  SELECT area, product_name, sum(n) AS click_count FROM by_city GROUP BY area, product_name),
remarks AS (
  SELECT area, product_name, city_remark(city_name, n) AS city_remark FROM by_city GROUP BY area, product_name)
SELECT t.area, t.product_name, CAST(t.click_count AS BIGINT) AS click_count, r.city_remark
FROM totals t JOIN remarks r ON t.area = r.area AND t.product_name = r.product_name
"""


def area_product_clicks_sql(spark) -> DataFrame:
    """A6 + A7 through ``spark.sql`` on the registered views, with U1 as a SQL function."""
    register_city_remark(spark)
    return spark.sql(AREA_REMARK_SQL)


def area_product_clicks(visits: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """A6 + A7: (area, product_name, click_count, city_remark)."""
    by_city = area_product_city_counts(visits, cities, products)
    return city_remark(by_city, ["area", "product_name"])


def area_product_top3(visits: DataFrame, cities: DataFrame, products: DataFrame,
                      top: int = 3) -> DataFrame:
    """``rank()`` per area by clicks desc, rank <= ``top``; ties at the cut all stay."""
    clicks = area_product_clicks(visits, cities, products)
    w = Window.partitionBy("area").orderBy(F.desc("click_count"))
    return (clicks.withColumn("rank", F.rank().over(w))
            .where(F.col("rank") <= top)
            .withColumn("rank", F.col("rank").cast("long")))


# The same R4 as Spark SQL over the temp views user_visit_action, city_info and
# product_info (see ``MallTables.register_views``). The counts per
# (city, product) come first, as in the DataFrame form: Catalyst does not push
# an aggregate below a join by itself.
AREA_TOP3_SQL = f"""
WITH clicks AS (
  SELECT city_id, click_product_id AS product_id, count(*) AS n
  FROM user_visit_action WHERE click_product_id > -1
  GROUP BY city_id, click_product_id),
by_city AS (
  SELECT c.area, p.product_name, coalesce(c.city_name, 'null') AS city_name, sum(k.n) AS n
  FROM clicks k JOIN city_info c ON k.city_id = c.city_id
  JOIN product_info p ON k.product_id = p.product_id
  GROUP BY c.area, p.product_name, coalesce(c.city_name, 'null')),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY area, product_name ORDER BY n DESC, city_name) AS rn,
         sum(n) OVER (PARTITION BY area, product_name) AS total,
         count(*) OVER (PARTITION BY area, product_name) AS cities
  FROM by_city),
top2 AS (
  SELECT area, product_name, max(total) AS click_count, max(cities) AS cities,
         max(CASE WHEN rn = 1 THEN city_name END) AS c1,
         max(CASE WHEN rn = 1 THEN n END) / max(total) AS r1,
         max(CASE WHEN rn = 2 THEN city_name END) AS c2,
         max(CASE WHEN rn = 2 THEN n END) / max(total) AS r2
  FROM ranked WHERE rn <= 2 GROUP BY area, product_name),
remark AS (
  SELECT area, product_name, CAST(click_count AS BIGINT) AS click_count,
         concat_ws('{REMARK_SEP}',
                   concat(c1, ':', format_number(r1, '0.00%')),
                   CASE WHEN c2 IS NOT NULL THEN concat(c2, ':', format_number(r2, '0.00%')) END,
                   CASE WHEN cities > 2
                        THEN concat('{OTHER_LABEL}:', format_number((1.0D - r1) - r2, '0.00%')) END)
           AS city_remark
  FROM top2)
SELECT area, product_name, click_count, city_remark, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS rank FROM remark)
WHERE rank <= 3
"""


def area_product_top3_sql(spark) -> DataFrame:
    """W1 etc. through ``spark.sql`` on the registered views."""
    return spark.sql(AREA_TOP3_SQL)
