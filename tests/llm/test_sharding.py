from __future__ import annotations

import collections

import numpy as np
import pytest

from clickpulse.llm import sharding
from tests.llm import helpers as H


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 2_000])
def test_shards_hold_every_row_once(spark, bucket_bytes):
    docs = H.odd_documents(spark).withColumnRenamed("x", "shard")
    got = sharding.shards(docs, 4, bucket_bytes=bucket_bytes).collect()
    rows = lambda xs: collections.Counter(map(tuple, xs))
    assert rows(r.record for r in got) == rows(docs.collect())
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots[k]) for k in range(4)]
    assert max(sizes) - min(sizes) <= 1


def test_order_is_shuffled_and_seeded(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "cast(id as string) as text").coalesce(1)
    order = lambda seed: [r.record.doc_id for r in sharding.shuffle_records(docs, seed=seed, bucket_bytes=40_000)
                          .orderBy("position").collect()]
    a, b, c = order(1), order(1), order(2)
    assert a == b != c and sorted(a) == list(range(4000))
    # near to uniform: the mean place of the first and the last half of the input hardly differ
    place = {d: p for p, d in enumerate(a)}
    assert abs(sum(place[d] for d in range(2000)) / 2000 - 2000) < 150
    assert sum(x < y for x, y in zip(a, a[1:])) / 4000 == pytest.approx(0.5, abs=0.05)


class Replay:
    """Fisher-Yates permutations as the engine draws them: a Mersenne twister per partition, seeded by seed + partition."""

    def __init__(self, seed: int) -> None:
        self.bits = np.random.RandomState(np.array([seed >> 32, seed & 0xFFFFFFFF], np.uint32))

    def below(self, n: int) -> int:
        draw = lambda: int(self.bits.randint(0, 1 << 32, dtype=np.uint32)) >> 1
        if n & -n == n:
            return n * draw() >> 31
        while (bits := draw()) - bits % n + n - 1 >= 1 << 31:
            pass
        return bits % n

    def permutation(self, n: int) -> list[int]:
        out = [0] * n
        for i in range(n):
            j = self.below(i + 1)
            out[i] = out[j]
            out[j] = i
        return out


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 20_000])
def test_permutation_replayed_from_its_seed(spark, bucket_bytes):
    docs = spark.range(2000).selectExpr("id as doc_id", "cast(id as string) as text").coalesce(1)
    held = collections.defaultdict(list)
    for r in sharding.permuted(docs, seed=77, bucket_bytes=bucket_bytes).orderBy("bucket", "place").collect():
        assert r.place == len(held[r.bucket])
        held[r.bucket].append(r.record.doc_id)
    assert sorted(d for b in held.values() for d in b) == list(range(2000))
    n, left = max(held) + 1, dict(held)
    # each partition's twister permutes its buckets one after another; which ones it holds, and in what order, is tried
    for partition in range(n):
        replay, going = Replay(77 + partition), True
        while going:
            state, going = replay.bits.get_state(), False
            for bucket, got in left.items():
                replay.bits.set_state(state)
                rows = sorted(got)
                if [rows[k] for k in replay.permutation(len(rows))] == got:
                    del left[bucket]
                    going = True
                    break
    assert not left


def test_plan_runs_no_python(spark):
    docs = H.odd_documents(spark)
    text = sharding.shards(docs)._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_written_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(H.odd_documents(spark), path, 3)
    back = spark.read.parquet(path)
    assert back.count() == len(H.odd_rows()) and back.select("shard").distinct().count() == 3


def test_empty_table(spark):
    assert sharding.shards(H.no_documents(spark)).count() == 0
