"""A list of (label, count) pairs as a JSON array of one-field objects.

``[("2", 30), ("3", 20)]`` -> ``[{"2":30},{"3":20}]``, the shape the original
jobs store for the top-3 ads and the per-minute trend.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pairs_json(pairs: Column, key_field: str, value_field: str) -> Column:
    """``pairs`` is an array of structs; order is kept as given."""
    return F.to_json(F.transform(pairs, lambda x: F.create_map(x[key_field], x[value_field])))
