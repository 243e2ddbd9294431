from __future__ import annotations

import collections
import re

import numpy as np
import pytest

from clickpulse.llm import divergence
from tests.llm.helpers import SCHEMA, key, no_documents, odd_rows, words

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    """Straight from the definition: every pair of groups, every kept term."""
    docs = [(r[2] or "", r[3] or "", TERM.findall((r[1] or "").translate(LOWER))) for r in rows]
    holders, out = collections.Counter((lang, t) for lang, _, ts in docs for t in set(ts)), set()
    for lang in {d[0] for d in docs}:
        kept = sorted(t for (l, t), n in holders.items() if l == lang and n >= min_docs)
        count = collections.defaultdict(collections.Counter)
        for l, source, ts in docs:
            if l == lang:
                count[source].update(t for t in ts if holders[lang, t] >= min_docs)
        whole = sum(count.values(), collections.Counter())

        def price(c):
            n = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: price(c) for s, c in count.items()}, price(whole)
        for s in count:
            lists = {"pair": [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in count if o != s],
                     "term": [(-f(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]}
            for part, items in lists.items():
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, -value, rank))
    return out


def corpus():
    rng, pool = np.random.default_rng(5), words(9, 150).split()
    rows = [(i, " ".join(rng.choice(pool[:20 + 9 * (i % 14)], 30)), ["en", "de", None][i % 3], f"s{i % 7}", None,
             "x", 1, 2, 3) for i in range(300)]
    rows += [(900 + i, "Hot HOT hot_hot9hot ÄÄ ää", "en", "s0", None, "x", 1, 2, 3) for i in range(150)]  # a third
    rows += [(5000, "rare only", "xx", "alone", None, "x", 1, 2, 3), (5001, "", "yy", "a", None, "x", 1, 2, 3),
             (5002, None, "yy", "b", None, "x", 1, 2, 3), (5003, "unseen", "yy", None, None, "x", 1, 2, 3)]
    return rows + odd_rows() + odd_rows()


@pytest.mark.parametrize("sizes", [{}, {"term_block": 20, "group_block": 2, "step": 7}])
def test_matches_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(divergence, "PIECE", 50)
    monkeypatch.setattr(divergence, "HELD", 200)
    rows = corpus()
    got = divergence.divergence(spark.createDataFrame(rows, SCHEMA).repartition(5), min_docs=4, top_terms=3, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    assert sorted(found, key=key) == sorted(brute(rows, 4, 3), key=key)


def test_sums_pass_32_bits_and_equal_prices(spark):
    rows = [(i, "aa bb " * 5000 if i % 2 else "bb cc " * 7000, "en", f"s{i % 4}", None, "x", 1, 2, 3) for i in range(24)]
    got = {tuple(r) for r in divergence.divergence(spark.createDataFrame(rows, SCHEMA), min_docs=2).collect()}
    assert got == brute(rows, 2, 10) and max(r[4] for r in got) > 1 << 28


def test_empty_table(spark):
    assert divergence.divergence(no_documents(spark)).count() == 0
