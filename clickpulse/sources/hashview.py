"""The stream results as (key, field, value) rows, the layout of the original
key-value store (S9, S10, C10).

The tables keep real columns; composite text keys are only built here, at the
boundary, for consumers that expect the hash layout. A name containing the
separator would make a key ambiguous, as it did in the original.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.text import composite_key

# Key prefixes of the original layout (the "clity" typo cleaned).
R6_PREFIX = "area:city:ads"
R7_PREFIX = "area:ads:top3"
R8_KEY = "last:hour:ads"


def day_area_city_ads_hash(counts: DataFrame, prefix: str = R6_PREFIX) -> DataFrame:
    """Key ``<prefix>:<day>``, field ``area:city:ads``, value the count."""
    return counts.select(
        composite_key(F.lit(prefix), F.col("day")).alias("key"),
        composite_key(F.col("area"), F.col("city"), F.col("ads_id")).alias("field"),
        F.col("cnt").cast("string").alias("value"))


def day_area_ads_top3_hash(top3_json: DataFrame, prefix: str = R7_PREFIX) -> DataFrame:
    """Key ``<prefix>:<day>``, field the area, value ``[{"ad":count},...]``."""
    return top3_json.select(composite_key(F.lit(prefix), F.col("day")).alias("key"),
                            F.col("area").alias("field"), F.col("ads_json").alias("value"))


def last_hour_hash(trend: DataFrame, key: str = R8_KEY) -> DataFrame:
    """One key, field the ad, value ``[{"HH:mm":count},...]``."""
    return trend.select(F.lit(key).alias("key"), F.col("ads_id").alias("field"),
                        F.col("minutes_json").alias("value"))
