"""Repeated passages: suffix-array dedup by distributed difference covers (op4).

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else,
in any document, is removed. The suffix order is made in parts that no equal
strings can straddle:

1. Partition. Each window of ``LENGTH`` bytes chooses an anchor, the ``GRAM``-byte
   string in it with the least hash, so equal windows choose equal anchors at
   equal places. Consecutive windows with one anchor form a context (up to
   LENGTH - GRAM + 1 windows and their bytes). An anchor that occurs once in the
   corpus settles its windows: none is repeated.
2. Equal contexts are counted; all windows of a context that occurs twice are
   repeated, however many copies there are, and one copy stands for all.
3. What is left are anchors whose contexts differ somewhere. Their contexts are
   fetched once and dealt to buckets by anchor; each bucket sorts its suffixes
   by the difference-cover algorithm (:mod:`suffixes`: sampled triples, names,
   recursion, merge) and compares the prefixes of adjacent suffixes byte by byte.
4. An anchor with more than ``HEAVY`` different contexts (a passage in very many
   documents) is split first: blocks of 8 windows, then single windows, keyed by
   the bytes that all windows of the block share, are counted as in step 2.
   Equal windows share that key, so nothing is lost.

Counts of anchors and contexts are aggregated before their shuffles; joins on
them leave skewed partitions to AQE.

Defined results: a null text is empty; texts shorter than ``LENGTH`` lose nothing;
repeated rows and rows with equal or null ids are occurrences of their own; extra
columns are ignored by :func:`repeated_passages` and kept by
:func:`without_repeats`; an empty table gives an empty result. A text is handled in
pieces of a megabyte until the last step, which holds it whole.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import BYTE_VALUES, Rolling, mix, runs, text_bytes, written
from clickpulse.llm.suffixes import repeated_starts

LENGTH = 200
GRAM = 48
HEAVY = 4096
BUCKET = 2 << 20   # context bytes in one bucket
PIECE = 1 << 20    # bytes hashed at once

ENTRY = "k1 long, k2 long, p0 long, n long, m long, w int, rel int, ahash long, chash long"
RANGE = "k1 long, k2 long, lo long, hi long"


def contexts(offsets: np.ndarray, data: np.ndarray, rolling: Rolling, length: int, gram: int):
    """(row, p0, m, w, rel, ahash, chash) arrays: contexts of the texts one after another in ``data``.

    p0 is the first window's start in its text, w the number of windows, rel the
    anchor's place after p0; m such contexts with the same bytes follow one another.
    """
    span, n = length - gram + 1, len(data)
    prefix = rolling.prefix(BYTE_VALUES[data])
    hashes = mix((prefix[gram:] - prefix[:-gram]) * rolling.down[:n - gram + 1])
    key = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    # least key of each window: minima from both ends of blocks as long as a window
    blocks = -(-len(key) // span)
    full = np.full(blocks * span, np.iinfo(np.uint64).max)
    full[:len(key)] = key
    full = full.reshape(blocks, span)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = np.minimum(back[:windows], ahead[span - 1:span - 1 + windows])
    sizes = np.diff(offsets)
    inside = np.repeat(offsets[1:], sizes)[:windows] - np.arange(windows) >= length
    at = np.flatnonzero(inside)
    anchor = (least[at] & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(at) else at
    p0, anchor = at[first], anchor[first]
    w = np.diff(first, append=len(at))
    ahash = hashes[anchor]
    rel = anchor - p0
    chash = rolling.spans(prefix, p0, p0 + w - 1 + length) ^ mix((w * 1024 + rel).astype(np.uint64))
    row = np.searchsorted(offsets, p0, "right") - 1
    # runs of the same context
    new = np.ones(len(p0), bool)
    new[1:] = (chash[1:] != chash[:-1]) | (ahash[1:] != ahash[:-1]) | (row[1:] != row[:-1]) | (p0[1:] != p0[:-1] + w[:-1])
    lead = np.flatnonzero(new)
    m = np.diff(lead, append=len(p0))
    return row[lead], (p0 - offsets[row])[lead], m, w[lead], rel[lead], ahash[lead], chash[lead]


def _entries(batches, length: int, gram: int):
    rolling = Rolling()
    for batch in batches:
        k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        offsets, data = text_bytes(batch.column(2))
        for i, j in runs(offsets, PIECE):
            size = int(offsets[j] - offsets[i])
            # a text longer than a piece goes in slices that share length - 1 bytes
            for shift in range(0, max(1, size - length + 1), PIECE if j == i + 1 else max(1, size)):
                upto = min(size, shift + PIECE + length - 1) if j == i + 1 else size
                if upto - shift < length:
                    continue
                edges = np.array([0, upto - shift]) if j == i + 1 else offsets[i:j + 1] - offsets[i]
                part = data[offsets[i] + shift:offsets[i] + upto]
                row, p0, m, w, rel, ahash, chash = contexts(edges, part, rolling, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[i + row]), pa.array(k2[i + row]), pa.array(p0 + shift), pa.array(m), pa.array(m),
                     pa.array(w.astype(np.int32)), pa.array(rel.astype(np.int32)),
                     pa.array(ahash.view(np.int64)), pa.array(chash.view(np.int64))],
                    ["k1", "k2", "p0", "n", "m", "w", "rel", "ahash", "chash"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2) tells rows apart: the id, and a hash of the text where ids repeat or are missing."""
    ids = docs.groupBy(F.col(id_col).cast("long").alias("i")).agg(F.count("*").alias("n"))
    plain = ids.agg(F.max(F.when(F.col("i").isNull(), 2).otherwise(F.col("n")))).first()[0] in (None, 1)
    text = F.coalesce(F.col(text_col), F.lit(""))
    k2 = F.lit(0).cast("long") if plain else F.xxhash64(text, F.col(id_col).isNull())
    return docs.withColumn("_k1", F.coalesce(F.col(id_col).cast("long"), F.lit(0))).withColumn("_k2", k2) \
        .withColumn("_text", text)


def _resolve(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(ranges of contexts that occur twice or more, contexts of anchors that have different ones)."""
    distinct = rows.groupBy("ahash", "chash").agg(
        F.sum("n").alias("c"), F.min(F.struct("k1", "k2", "p0", "w", "rel", "x")).alias("r"))
    twice = distinct.filter("c >= 2").select("ahash", "chash")
    ranges = rows.join(twice, ["ahash", "chash"]).select(
        "k1", "k2", F.col("p0").alias("lo"), (F.col("p0") + F.col("m") * F.col("w") + F.lit(length - 1)).alias("hi"))
    mixed = distinct.groupBy("ahash").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    return ranges, distinct.join(mixed, "ahash").select("ahash", "kinds", "c", "r.*")


def _fetch(mixed: DataFrame, keyed: DataFrame, length: int) -> DataFrame:
    """The contexts with their bytes ``x``, cut from the documents that hold them."""
    wanted = mixed.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("p0", "w", "rel", "c", "kinds", "ahash")).alias("list"))

    def cut(batches):
        for batch in batches:
            offsets, data = text_bytes(batch.column(2))
            lists = batch.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            row = np.repeat(np.arange(len(batch)), sizes)
            p0, w = flat.field("p0").to_numpy(), flat.field("w").to_numpy()
            lo = offsets[row] + p0
            x = [data[i:j].tobytes() for i, j in zip(lo, lo + w - 1 + length)]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *(flat.field(f) for f in
                 ("p0", "w", "rel", "c", "kinds", "ahash")), pa.array(x, pa.binary())],
                ["k1", "k2", "p0", "w", "rel", "c", "kinds", "ahash", "x"])

    texts = keyed.select(F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.col("_text").alias("text"))
    texts = texts.join(wanted, ["k1", "k2"])
    got = texts.select("k1", "k2", "text", "list").mapInArrow(
        cut, "k1 long, k2 long, p0 long, w int, rel int, c long, kinds long, ahash long, x binary")
    # rows that are equal in every column yield a context of theirs each
    return got.dropDuplicates(["k1", "k2", "p0", "ahash"])


def _refine(batches, block: int, length: int):
    """Contexts of heavy anchors cut into blocks of windows, keyed by the bytes the block's windows share."""
    digest = lambda *parts: int.from_bytes(
        hashlib.blake2b(b"\0".join(parts), digest_size=8).digest(), "little", signed=True)
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            x, w, rel, anchor = r["x"], r["w"], r["rel"], b"%d" % r["ahash"]
            # blocks are counted from the anchor: equal windows stand equally far before it
            for j in range((rel - w + 1) // block, rel // block + 1):
                d0 = rel - (j * block + block - 1)
                lo, hi = max(0, d0), min(w, d0 + block)
                core, own = x[d0 + block - 1:d0 + length], x[lo:hi - 1 + length]
                rows.append({"k1": r["k1"], "k2": r["k2"], "p0": r["p0"] + lo, "n": r["c"], "m": 1, "w": hi - lo,
                             "rel": rel - lo, "ahash": digest(anchor, b"%d" % j, core),
                             "chash": digest(b"%d,%d" % (hi - lo, rel - lo), own), "x": own})
        kinds = {"w": pa.int32(), "rel": pa.int32(), "x": pa.binary()}
        names = ("k1", "k2", "p0", "n", "m", "w", "rel", "ahash", "chash", "x")
        yield pa.RecordBatch.from_pylist(rows, pa.schema([(c, kinds.get(c, pa.int64())) for c in names]))


def _sorted_bucket(t: pa.Table, length: int) -> pa.Table:
    """Ranges of the repeated windows in one bucket's contexts that occur once."""
    flags = repeated_starts(t["x"].to_pylist(), t["w"].to_pylist(), length)
    k1, k2, p0, c = (t[x].to_numpy() for x in ("k1", "k2", "p0", "c"))
    rows, lo, hi = [], [], []
    for i, f in enumerate(flags):
        if c[i] > 1 or not f.any():
            continue
        edge = np.flatnonzero(np.diff(np.r_[False, f, False]))
        rows += [i] * (len(edge) // 2)
        lo += (p0[i] + edge[::2]).tolist()
        hi += (p0[i] + edge[1::2] - 1 + length).tolist()
    rows = np.array(rows, np.int64)
    return pa.table({"k1": k1[rows], "k2": k2[rows], "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})


def repeated_ranges(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, heavy: int = HEAVY,
                    bucket: int = BUCKET) -> DataFrame:
    """(k1, k2, lo, hi): byte ranges that repeated strings cover, overlapping ones included."""
    texts = keyed.select("_k1", "_k2", "_text")
    entries = texts.mapInArrow(lambda it: _entries(it, length, gram), ENTRY)
    repeated = entries.groupBy("ahash").agg(F.sum("n").alias("times")).filter("times >= 2").select("ahash")
    rows = written(entries.join(repeated, "ahash"), "entries").withColumn("x", F.lit(None).cast("binary"))
    ranges, mixed = _resolve(rows, length)
    found = [ranges]
    held = written(_fetch(mixed, keyed, length), "contexts")
    light = []

    def refine(block: int):
        return lambda it: _refine(it, block, length)

    for block in (8, 1):
        big = held.filter(F.col("kinds") > heavy)
        light.append(held.filter(F.col("kinds") <= heavy))
        if big.isEmpty():
            break
        split = written(big.mapInArrow(refine(block), ENTRY + ", x binary"), "split")
        ranges, mixed = _resolve(split, length)
        found.append(ranges)
        held = written(mixed, "contexts")
    else:
        light.append(held)  # single windows: equal keys are equal strings, so nothing is left
    left = light[0]
    for more in light[1:]:
        left = left.unionByName(more)
    total = left.agg(F.sum(F.octet_length("x").cast("long"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket))
    place = F.pmod(F.xxhash64("ahash"), F.lit(buckets)).alias("bucket")
    found.append(left.select(place, "k1", "k2", "p0", "w", "c", "x").groupBy("bucket")
                 .applyInArrow(lambda t: _sorted_bucket(t, length), RANGE))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _joined(docs: DataFrame, id_col: str, text_col: str, length: int, options: dict) -> DataFrame:
    """``docs`` with ``_text`` and the sorted list ``_ranges`` of ranges to remove (or null)."""
    keyed = _keyed(docs, id_col, text_col)
    lists = repeated_ranges(keyed, length, **options).groupBy("k1", "k2").agg(
        F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("_ranges"))
    return keyed.join(lists.withColumnsRenamed({"k1": "_k1", "k2": "_k2"}), ["_k1", "_k2"], "left")


def _kept(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, int, int]:
    """(bytes outside the ranges, number removed, number of maximal removed runs)."""
    if not len(lo):
        return text, 0, 0
    reach = np.maximum.accumulate(hi)
    first = np.flatnonzero(np.r_[True, lo[1:] > reach[:-1]])
    starts, ends = lo[first], reach[np.r_[first[1:] - 1, len(lo) - 1]]
    out, done = [], 0
    for i, j in zip(starts.tolist(), ends.tolist()):
        out.append(text[done:i])
        done = j
    out.append(text[done:])
    return b"".join(out), int((ends - starts).sum()), len(first)


def _cut_rows(batch: pa.RecordBatch, text_at: int, ranges_at: int):
    """(row, text, kept bytes, removed, spans) of a batch."""
    offsets, data = text_bytes(batch.column(text_at))
    lists = batch.column(ranges_at)
    ends = lists.offsets.to_numpy()
    lo, hi = lists.values.field("lo").to_numpy(), lists.values.field("hi").to_numpy()
    missing = lists.is_null().to_numpy(zero_copy_only=False)
    for row in range(len(batch)):
        text = data[offsets[row]:offsets[row + 1]].tobytes()
        a, b = (0, 0) if missing[row] else (ends[row], ends[row + 1])
        yield row, text, *_kept(text, lo[a:b], hi[a:b])


def repeated_passages(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            got = [(len(t), removed, spans, hashlib.sha256(kept).hexdigest())
                   for _, t, kept, removed, spans in _cut_rows(batch, 1, 2)]
            cols = list(zip(*got)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _joined(picked, "doc_id", "text", length, options).select("doc_id", "_text", "_ranges")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """``docs``, all columns, with the repeated bytes cut out of the text.

    A character that loses some of its bytes goes as a whole.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # no name of ``docs`` can clash
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches):
        for batch in batches:
            texts = [kept.decode("utf-8", "ignore") for _, _, kept, _, _ in _cut_rows(batch, len(names), len(names) + 1)]
            cols = list(batch.columns)[:len(names)]
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    joined = _joined(docs.toDF(*names), names[docs.columns.index(id_col)], names[at], length, options)
    return joined.select(*names, "_text", "_ranges").mapInArrow(run, schema)
