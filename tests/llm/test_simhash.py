from __future__ import annotations

import numpy as np
import pytest
import xxhash

from clickpulse.llm import simhash
from clickpulse.llm.components import local_components, star_components
from tests.llm import helpers as H


def plain_fingerprint(text):
    w = H.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_groups_match_brute_force(spark):
    rows = [r for r in H.odd_rows() if r[0] is not None]
    got = simhash.near_duplicates(H.odd_documents(spark)).collect()
    prints = {}
    for i, text, *_ in rows:
        prints.setdefault(i, set()).add(plain_fingerprint(text))
    near = H.components(sorted(prints), lambda a, b: any(
        (x ^ y).bit_count() <= 2 for x in prints[a] for y in prints[b]))
    assert len(got) == len(H.odd_rows())
    for r in got:
        if r.doc_id is not None:
            assert int(r.fingerprint, 16) in prints[r.doc_id] and r.component_id == near[r.doc_id]
    assert near[6] == 5  # null and empty texts share fingerprint zero


@pytest.mark.parametrize("hot", [False, True])
def test_vantage_point_shards_lose_no_link(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "SHARD", 60)
    monkeypatch.setattr(simhash, "BLOCK", 1 << 10)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    if hot:  # a third of all in one small ball
        base[:100] = base[0]
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 4, 300)], np.uint64)
    values = np.unique(np.concatenate([base, base ^ flips]))
    edges = simhash.near_links(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long"))
    got = {r.a: r.b for r in star_components(edges).collect()}
    a, b = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
    label = local_components(len(values), a, b)
    signed = values.view(np.int64)
    root = {}
    for v, k in zip(signed.tolist(), label.tolist()):
        root[k] = min(root.get(k, v), v)
    assert {v: got.get(v, v) for v in signed.tolist()} == {v: root[k] for v, k in zip(signed.tolist(), label.tolist())}


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100)], "a long, b long")
    assert {(r.a, r.b) for r in star_components(edges).collect()} == {(i, 0) for i in range(1, 61)}


def test_one_per_group_keeps_columns(spark):
    docs = H.odd_documents(spark)
    kept = simhash.one_per_group(docs)
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 3 in ids and 9 not in ids and 5 in ids and 6 not in ids
    assert ids.count(8) == 2  # rows of one id stay together


def test_one_row_per_group_with_null_and_repeated_ids(spark):
    a, b, c = (H.words(k, 80) for k in (21, 22, 23))
    rows = [(1, a), (1, a), (None, a), (2, b), (None, b), (None, c), (None, c), (3, a), (None, b), (1, b)]
    docs = spark.createDataFrame([(i, t, "row") for i, t in rows], "doc_id long, text string, row string").repartition(4)
    kept = simhash.one_row_per_group(docs)
    assert kept.schema == docs.schema
    want = sorted([(1, a), (1, b), (None, c)], key=H.key)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=H.key) == want
    # by document: the equal rows of id 1 stay, no null-id row of another group does
    kept = simhash.one_per_group(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=H.key) == sorted([*want, (1, a)], key=H.key)


def test_empty_table(spark):
    assert simhash.near_duplicates(H.no_documents(spark)).count() == 0
    assert simhash.one_per_group(H.no_documents(spark)).count() == 0
