from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from clickpulse.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label string, code string, error int, entry long"


def brute(rows, entries=64, rounds=2, parts=16):
    """Plain Python: every part against every entry."""
    good = [(i, label, [math.floor(256 * x) if abs(x) < 2.0 ** 44 else 256 * int(x) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not good:
        return set()
    width = max(1, math.ceil(max(len(v) for _, _, v in good) / parts))
    good = sorted([(i, label, v + [0] * (width * parts - len(v))) for i, label, v in good],
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, _, v in good[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))
                 for p in range(parts)] for _, _, v in good]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut(v, p) for (_, _, v), a in zip(good, found) if a[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in a) for a in found]
    total = {}
    for (_, label, _), e in zip(good, errors):
        total[label] = total.get(label, 0) + min(e, codes.LONG)
    return sorted(((i, "".join(f"{k:02x}" for _, k in a), min(e, codes.LONG), min(total[label], codes.LONG), sha)
                   for (i, label, _), a, e in zip(good, found, errors)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)


def some(seed, n, d=32, spread=0.3):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in rng.normal(0, spread, d)], f"l{i % 5}") for i in range(n)]


@pytest.mark.parametrize("block", [1 << 14, 50])
def test_matches_plain_python(spark, block):
    rows = some(1, 400)
    rows[100:230] = [(i, rows[100][1], None) for i, _, _ in rows[100:230]]  # a third alike, ties
    rows += [(7, rows[9][1], "l1"), (None, [0.25] * 32, None), (900, None, "l1"), (901, [0.1, None], "l2"),
             (902, [float("nan")] * 32, "l3"), (903, [float("inf")] * 32, None), (904, [], "l4"), (905, [0.5] * 3, "l0"),
             (906, [-0.0001] * 33, "l0")]
    got = codes.code_digest(frame(spark, rows), block=block)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_few_rows_and_one_part_each(spark):
    rows = some(2, 9, 5)
    assert sorted((tuple(r) for r in codes.code_digest(frame(spark, rows)).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("huge", [1e30, 3e6, 1e300])
def test_huge_components(spark, huge):
    rows = some(3, 150, 16)
    rows[3] = (3, [huge] + [0.5] * 15, "l1")
    rows[90] = (90, [-huge] * 16, "l2")
    assert sorted((tuple(r) for r in codes.code_digest(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_ball_step_equals_full_comparison():
    rng = np.random.default_rng(4)
    for trial in range(60):
        width, n, k = int(rng.integers(1, 5)), int(rng.integers(1, 400)), int(rng.integers(1, 64))
        size = int(rng.choice([2, 5, 300, 1 << 29]))  # small sizes: many ties and equal entries
        x, entries = rng.integers(-size, size, (n, width)), rng.integers(-size, size, (k, width))
        own = codes.nearest(x, entries + rng.integers(-2, 3, entries.shape))[0]
        got, want = codes.ball_nearest(x, entries, own), codes.nearest(x, entries)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_stable_cores_and_rings_save_distances(monkeypatch):
    rng = np.random.default_rng(6)
    entries = rng.integers(-5000, 5000, (64, 4))
    x = entries[rng.integers(0, 64, 5000)] + rng.integers(-60, 60, (5000, 4))
    own, _ = codes.nearest(x, entries)
    done = []
    plain = codes._squares
    monkeypatch.setattr(codes, "_squares", lambda a, b: done.append(len(a) * len(b)) or plain(a, b))
    codes.ball_nearest(x, entries, own)
    assert sum(done) - 64 * 64 < 0.05 * len(x) * 64


def test_decoded_vectors_are_the_entries(spark):
    rows = some(8, 120)
    coded, books = codes.compress(frame(spark, rows))
    whole = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows}
    errors = {r["vec_id"]: r["error"] for r in coded.collect()}
    for r in codes.decoded(coded, books).collect():
        assert sum((a - b) ** 2 for a, b in zip(whole[r["vec_id"]], r["vec"])) == errors[r["vec_id"]]


def test_empty_table(spark):
    assert codes.code_digest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert codes.code_digest(frame(spark, [(1, None, "a")])).count() == 0
