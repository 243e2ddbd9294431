"""Declared schemas of the input records and a typed decode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("gender", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

# One ad click: epoch milliseconds, area, city, user and ad ids as text.
ADS_INFO = T.StructType([
    T.StructField("ts", T.LongType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ads_id", T.StringType()),
])


class SchemaMismatch(ValueError):
    pass


def decode(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in order, cast to the declared types.

    A missing column is an error (as a typed decode fails); extra columns are
    dropped, which lets the scan prune them.
    """
    have = {c.lower() for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise SchemaMismatch(f"missing columns {missing}; have {df.columns}")
    # cast by type name: one gateway call per column instead of a DataType round trip
    return df.select([F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in schema.fields])
