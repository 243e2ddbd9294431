"""SimHash near-duplicates over vantage-point shards (op2).

Fingerprints of distinct value are partitioned by a vantage-point tree: a node
holds a point v and a radius mu, fingerprints at Hamming distance d <= mu go
left, the others right. By the triangle bound a pair within distance r that a
node separates has its outer member at mu < d <= mu + r, so just those are also
sent, as queries, to the left shard; every linked pair meets in the home shard
of its inner member. The tree is fitted on a bounded sample of fingerprints
(``MAX_SAMPLE``); each shard goes on splitting by the same rule until a block of
exact comparisons is small. A shard returns star edges of its local components,
never its pairs; the components of the edges are found by joins.

Words are runs of characters other than space and ``\\x09-\\x0D`` after
lower-casing A-Z; shingles are ``width`` words joined by a space (a shorter text:
all its words), repeats included, hashed by XXH64 with seed 42. A null or empty
text has fingerprint zero and is linked like any other. Rows with an equal id
count as one document; a row without an id joins a group but never names it.
Other columns are ignored by :func:`near_duplicates` and kept by
:func:`one_per_group` and :func:`one_row_per_group`, which tell rows apart by a
number written with them, so that repeated and null ids are no rows of another
group. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import text_bytes, written
from clickpulse.llm.components import local_components, star_components

SEED = 42
MAX_BITS = 2
WIDTH = 3
SHARD = 20_000           # distinct fingerprints aimed at in one shard
MAX_SAMPLE = 1 << 18     # fingerprints the tree may be fitted on (2 MB)
SAMPLE_PER_SHARD = 64
BLOCK = 1 << 22          # comparisons made at once


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()  # bytes: lower-cases A-Z only, splits at space and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    n = max(1, len(words) - width + 1)
    ends = [s - 1 for s in starts[min(width, len(words)):]]
    spans = map(slice, starts[:n], ends)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        part = hashes[i:i + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
                 *also: str) -> DataFrame:
    """(doc_id, fp) with fp the fingerprint's 64 bits as a signed long, and the long columns ``also``."""
    def run(batches):
        for batch in batches:
            offsets, data = text_bytes(batch.column(1))
            got = [fingerprint(data[i:j].tobytes(), width) for i, j in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(got, np.uint64).view(np.int64)), *batch.columns[2:]],
                ["doc_id", "fp", *also])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *also)
    return picked.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *also)))


def _distance(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to)


def _choose(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The vantage point, of eight spread over ``points``, whose distances vary most, and its radius."""
    tries = points[np.linspace(0, len(points) - 1, 8).astype(int)]
    best = max(tries, key=lambda v: float(_distance(points, v).astype(np.float64).var()))
    d = np.sort(_distance(points, best))
    if d[0] == d[-1]:
        return None
    mu = int(d[len(d) // 2])
    if mu == d[-1]:
        mu = int(d[np.searchsorted(d, mu) - 1])
    return best, mu


def fit_tree(sample: np.ndarray, shards: int) -> list[tuple[int, int, int, int]]:
    """Nodes (point, radius, left, right); a negative child -1-k is shard k."""
    nodes: list = []
    leaves = 0

    def grow(points: np.ndarray, want: int) -> int:
        nonlocal leaves
        split = _choose(points) if want > 1 and len(points) > 1 else None
        if split is None:
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append(None)
        inside = _distance(points, split[0]) <= split[1]
        part = max(1, min(want - 1, round(want * float(inside.mean()))))
        left = grow(points[inside], part)
        nodes[at] = (int(split[0]), split[1], left, grow(points[~inside], want - part))
        return at

    grow(np.sort(sample), shards)
    return nodes


def _split(home: np.ndarray, foreign: np.ndarray, point: np.uint64, mu: int, r: int):
    """((home, foreign) of the left child, of the right child): index arrays."""
    dh, df = _distance(home, point), _distance(foreign, point).astype(np.int16)
    crossing = np.flatnonzero((dh > mu) & (dh.astype(np.int16) <= mu + r))
    return ((np.flatnonzero(dh <= mu), np.flatnonzero(df <= mu + r), crossing),
            (np.flatnonzero(dh > mu), np.flatnonzero(df > mu - r)))


def route(fps: np.ndarray, nodes: list, r: int):
    """(shard, fingerprints, home) triples: where each fingerprint lives and where it must ask."""
    stack = [(0 if nodes else -1, fps, fps[:0])]
    while stack:
        at, home, foreign = stack.pop()
        if not len(home) and not len(foreign):
            continue
        if at < 0:
            yield -1 - at, home, True
            yield -1 - at, foreign, False
            continue
        point, mu, left, right = nodes[at]
        (hl, fl, crossing), (hr, fr) = _split(home, foreign, np.uint64(point), mu, r)
        stack.append((left, home[hl], np.concatenate([foreign[fl], home[crossing]])))
        stack.append((right, home[hr], foreign[fr]))


def shard_links(home: np.ndarray, foreign: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (fingerprint, its local root) of all pairs within r that have a home member."""
    every = np.concatenate([home, foreign])
    label = np.arange(len(every))
    ea, eb, pending = [label[:0]], [label[:0]], 0
    stack = [(np.arange(len(home)), np.arange(len(home), len(every)))]

    def settle():
        nonlocal label, ea, eb, pending
        rooted = np.arange(len(every))
        label = local_components(len(every), np.concatenate([rooted, *ea]), np.concatenate([label, *eb]))
        ea, eb, pending = [rooted[:0]], [rooted[:0]], 0

    while stack:
        h, f = stack.pop()
        if not len(h):
            continue
        split = _choose(every[h]) if len(h) * (len(h) + len(f)) > BLOCK and len(h) > 64 else None
        if split is not None:
            (hl, fl, crossing), (hr, fr) = _split(every[h], every[f], split[0], split[1], r)
            stack.append((h[hl], np.concatenate([f[fl], h[crossing]])))
            stack.append((h[hr], f[fr]))
            continue
        q = np.concatenate([h, f])
        step = max(1, BLOCK // len(q))
        for i in range(0, len(h), step):
            a, b = np.nonzero(np.bitwise_count(every[h[i:i + step], None] ^ every[q][None, :]) <= r)
            a, b = h[i:i + step][a], q[b]
            apart = a != b
            ea.append(a[apart])
            eb.append(b[apart])
            pending += int(apart.sum())
            if pending > 1 << 20:
                settle()
    settle()
    linked = np.flatnonzero(label != np.arange(len(every)))
    return every[linked], every[label[linked]]


def near_links(fps: DataFrame, r: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) spanning the graph of distinct fingerprints within ``r`` bits.

    ``fps`` has one long column fp without repeats.
    """
    n = fps.count()
    shards = max(1, math.ceil(n / SHARD))
    share = min(1.0, min(MAX_SAMPLE, max(4096, SAMPLE_PER_SHARD * shards)) / max(1, n))
    picked = fps.filter((F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))))
    sample = np.array([x.fp for x in picked.collect()], np.int64).view(np.uint64) if shards > 1 else np.zeros(0, np.uint64)
    nodes = fit_tree(sample, shards) if len(sample) else []

    def send(batches):
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            for shard, got, home in route(points, nodes, r):
                if len(got):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(got), shard, np.int32)), pa.array(got.view(np.int64)),
                         pa.array(np.full(len(got), home))], ["shard", "fp", "home"])

    def link(t: pa.Table) -> pa.Table:
        points, home = t["fp"].to_numpy().view(np.uint64), t["home"].to_numpy()
        a, b = shard_links(np.sort(points[home]), np.sort(points[~home]), r)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = fps.mapInArrow(send, "shard int, fp long, home boolean")
    return sent.groupBy("shard").applyInArrow(link, "a long, b long")


def _rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct`` (one row per fp) with the root of each fingerprint's component."""
    star = star_components(near_links(distinct.select("fp"), max_bits))
    return distinct.join(star.select(F.col("a").alias("fp"), F.col("b").alias("up")), "fp", "left") \
        .select("fp", "first", F.coalesce("up", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    prints = written(fingerprints(docs, width, id_col, text_col), "simhash")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    rooted = _rooted(distinct, max_bits)
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _represented(docs: DataFrame, width: int, max_bits: int, id_col: str, text_col: str):
    """``docs`` as c0, c1, ... with a row number, (row, doc_id, fp) of its rows, (fp, root) and (root, first).

    first is the (no id, doc_id, row) of the row that stands for its component: the least id, nulls last.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # no name of ``docs`` can clash
    id_at, text_at = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    # written once: the numbers stay what they are however often the rows are read
    rows = written(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "rows")
    prints = fingerprints(rows, width, id_at, text_at, "row")
    prints = written(prints, "simhash")
    distinct = written(prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")), "distinct")
    rooted = _rooted(distinct, max_bits)
    return rows, prints, rooted.select("fp", "root"), rooted.groupBy("root").agg(F.min("first").alias("first"))


def _these(rows: DataFrame, stay: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.join(stay, "row", "left_semi").drop("row").toDF(*docs.columns)


def one_per_group(docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, all columns: the rows in the group that have its least id.

    A group without any id keeps one row.
    """
    rows, prints, rooted, best = _represented(docs, width, max_bits, id_col, text_col)
    stay = prints.join(rooted, "fp").join(best, "root") \
        .filter((F.col("doc_id") == F.col("first.doc_id")) | (F.col("row") == F.col("first.row"))).select("row")
    return _these(rows, stay, docs)


def one_row_per_group(docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each group, all columns: of the least id (nulls last) the first row."""
    rows, _, _, best = _represented(docs, width, max_bits, id_col, text_col)
    return _these(rows, best.select("first.row"), docs)
