"""Connected components of a graph given as an edge table, by alternating stars.

Only aggregates and joins on node ids: a hub is pre-aggregated before its
shuffle, and the join back leaves skewed partitions to AQE. Each round is
written to the shared scratch folder, so its lineage ends there.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import written


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node index reachable from each of ``n`` nodes over edges a-b."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        live = la != lb
        if not live.any():
            break
        a, b, la, lb = a[live], b[live], la[live], lb[live]
        low = np.minimum(la, lb)
        np.minimum.at(label, np.maximum(la, lb), low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def star_components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(a, b) with b the smallest node of a's component, for every node a that is not it.

    ``edges`` has long columns a and b; direction, repeats and loops do not matter.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = written(edges.filter("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "star")
    state = _state(edges)
    for _ in range(rounds):
        if not state[0]:
            return edges
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.distinct(), "star")
        before, state = state, _state(edges)
        if state == before:
            return edges
    raise RuntimeError(f"components did not settle in {rounds} rounds")
