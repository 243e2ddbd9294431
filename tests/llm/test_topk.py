from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpulse.llm import topk

SCHEMA = "vec_id long, embedding array<float>, id int, part string"


def brute(rows, k, every):
    good = [(i, [math.floor(64.0 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, v in good:
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in good if j != i)
        out |= {(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k])}
    return out


def vectors(seed, n, d=16):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.normal(0, 0.4, d)]) for i in range(n)]


@pytest.mark.parametrize("cell", [1 << 14, 50])
def test_matches_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(topk, "CELL_ROWS", cell)
    monkeypatch.setattr(topk, "CELL_QUERIES", 7 if cell == 50 else 1 << 11)
    rows = vectors(1, 240)
    rows[60:140] = [(i, rows[60][1]) for i, _ in rows[60:140]]  # a third alike: ties
    rows += [(500, None), (501, [1.0, None] + [0.0] * 14), (502, [float("nan")] * 16), (503, [float("inf")] * 16),
             (520, []), (521, [0.5] * 3), (None, [0.3] * 16), (7, rows[7][1])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    got = topk.top_k(docs, F.col("id") % 20 == 0, k=20)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute(rows, 20, 20)


def test_fewer_candidates_and_repeated_queries(spark):
    rows = vectors(2, 5) + vectors(2, 1)
    got = topk.top_k(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), F.col("id") == 0, k=20).collect()
    assert {tuple(r) for r in got} == brute(rows, 20, 1 << 40) and len(got) == 4


def test_large_components(spark):
    rows = [(i, [v * 1e6 for v in x]) for i, x in vectors(3, 60)]
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in rows]
    got = topk.top_k(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), F.col("id") % 20 == 0, k=5).collect()
    assert {tuple(r) for r in got} == brute(rows, 5, 20)


@pytest.mark.parametrize("huge", [1e30, 4e7, 3e38])
def test_huge_finite_components(spark, huge):
    """Scores beyond 64 bits are given as the largest magnitude, ties there to the smaller id."""
    rows = vectors(4, 90, 8)
    huge = float(np.float32(huge))
    rows[5] = (5, [huge] + rows[5][1][1:])
    rows[20] = (20, [-huge] * 8)
    rows[40] = (40, [float(np.float32(huge / 3)), -huge] + [0.0] * 6)
    got = topk.top_k(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), F.col("id") % 20 == 0, k=7).collect()
    good = [(i, [math.floor(64 * v) if abs(v) < 2.0 ** 44 else 64 * int(v) for v in x]) for i, x in rows]
    cut = lambda s: max(-topk.LONG, min(topk.LONG, s))
    want = set()
    for i, v in good:
        if i % 20 == 0:
            scored = sorted((-cut(sum(a * b for a, b in zip(v, w))), j) for j, w in good if j != i)
            want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:7])}
    assert {tuple(r) for r in got} == want


def test_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("id") % 20 == 0).count() == 0
