"""Vector code compression with ball k-means (op12).

A vector of integers (each component floor(scale * x)) is cut into ``PARTS`` equal
consecutive parts, and each part is replaced by the index of the nearest entry of its
position's codebook. A codebook starts as that part of the ``ENTRIES`` rows with the
smallest ids; a round assigns every part and moves each entry to the componentwise floor
of the mean of its parts.

The first round compares each part with all entries. After it every entry is the centre
of a ball: in a block of rows its radius is the distance of the farthest of its parts.
All comparisons are between integers, squares of distances:

* Neighbours: only entries nearer to the centre than twice the radius can take a part.
* Stable core: a part nearer to its centre than half the way to the nearest other entry
  stays; no distance is computed for it.
* Rings: the neighbours lie sorted by their distance from the centre, and a part is
  compared with those that are at most twice as far from the centre as the part is, which
  by the triangle inequality are all that can be as near.

Rows stay in their partitions: a round reads the rows with their codes, writes them with
the new codes and sends sums and counts of 16 x 64 entries per task, which Spark adds up.
The driver holds the codebooks (bounded by 64 entries times the vector's length).

Defined results: rows whose vector is null or holds a null, NaN or infinite component are
dropped; shorter vectors count as padded with zeros up to the longest, and the longest as
padded to a multiple of 16; equal rows count each; among equal ids the smaller vector
comes first, null ids come last; with fewer than 64 rows there are as many entries; extra
columns are ignored; an empty table gives an empty result. Integers are exact at any size
(Python integers where 64 bits do not suffice, which is slower); errors beyond 64 bits
are given as 2^63 - 1. A component of 2^1015 or more in magnitude counts as infinite. A
worker holds ``BLOCK`` vectors or one batch.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 16_384     # rows assigned at once
LIMB = 30          # bits of the pieces in which sums are added up
LONG = (1 << 63) - 1
LARGEST = 2.0 ** 1015
_ROW = [("vec_id", pa.int64()), ("label", pa.string()), ("vec", pa.list_(pa.float64())), ("code", pa.binary())]
_STATE = pa.schema([*_ROW, ("entry", pa.int32()), ("limb", pa.int32()), ("sums", pa.int64())])
_STATE_SQL = "vec_id long, label string, vec array<double>, code binary, entry int, limb int, sums long"


def integer_vectors(df: DataFrame, scale: int, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vec): sound rows, components floor(scale * x) as whole doubles."""
    sound = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST))
    # beyond 2^52 doubles are whole already, and floor() would leave the 64-bit range
    whole = F.transform(vec_col, lambda x: F.when(
        F.abs(x.cast("double")) < float(1 << 44), F.floor(x.cast("double") * scale).cast("double"))
        .otherwise(x.cast("double") * scale))
    return df.filter(F.coalesce(sound, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        whole.alias("vec"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` integers, padded with zeros; Python integers if any exceeds 2^62."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(column)), lengths)
    at = np.arange(len(rows)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    big = len(flat) and np.abs(flat).max() > 2.0 ** 62
    out = np.zeros((len(column), width), object if big else np.int64)
    out[rows, at] = [int(x) for x in flat.tolist()] if big else flat.astype(np.int64)
    return out


def _safe(width: int) -> int:
    """Largest magnitude of a component with which four times a squared distance fits 63 bits."""
    return math.isqrt((1 << 58) // max(1, width))


def _fit(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers where distances then fit, else as Python integers."""
    most = _safe(x.shape[1])
    if all(not a.size or (abs(a) <= most).all() for a in (x, entries)):
        return x.astype(np.int64), entries.astype(np.int64)
    return x.astype(object), entries.astype(object)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``x`` from every entry."""
    if x.dtype != object and (not x.size or np.abs(x).max(initial=0) + np.abs(entries).max(initial=0)
                              <= math.isqrt((1 << 53) // max(1, x.shape[1]))):
        a, b = x.astype(np.float64), entries.astype(np.float64)  # every step is a whole number below 2^53
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), x.dtype)
    for k in range(x.shape[1]):
        gap = x[:, k, None] - entries[None, :, k]
        out += gap * gap
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row, compared with all entries; ties to the lower index."""
    x, entries = _fit(x, entries)
    d = _squares(x, entries)
    best = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
    return best, d[np.arange(len(d)), best]


def ball_nearest(x: np.ndarray, entries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, from the entries ``own`` of the last round, see the module's head."""
    x, entries = _fit(x, entries)
    gap = x - entries[own]
    d, best = (gap * gap).sum(axis=1), own.copy()
    between = _squares(entries, entries)
    by_entry = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[by_entry], np.arange(len(entries) + 1))
    for i in range(len(entries)):
        members = by_entry[cuts[i]:cuts[i + 1]]
        if not len(members):
            continue
        others = np.argsort(between[i], kind="stable")
        others = others[others != i]
        away = between[i][others]
        radius = d[members].max()
        others = others[:np.searchsorted(away, 4 * radius, "right")]  # neighbours of the ball
        away = away[:len(others)]
        if not len(others):
            continue
        members = members[4 * d[members] >= away[0]]  # the rest is the stable core
        if not len(members):
            continue
        ring = np.searchsorted(away, 4 * d[members], "right")
        order = np.argsort(-ring, kind="stable")
        members, ring = members[order], ring[order]
        # rings from the inside: the first n members reach the neighbours lo to hi
        hi = 0
        while hi < ring[0]:
            lo, hi = hi, min(max(2 * hi, 8), int(ring[0]))
            n = int(np.searchsorted(-ring, -lo, "left"))  # members whose ring holds neighbour lo
            m, some = members[:n], others[lo:hi]
            far = _squares(x[m], entries[some])
            least = far.min(axis=1)
            low = np.where(far == least[:, None], some, len(entries)).min(axis=1)
            take = (least < d[m]) | ((least == d[m]) & (low < best[m]))
            # d[m] may only shrink, so rings counted from the centre stay wide enough
            best[m[take]], d[m[take]] = low[take], least[take]
    return best, d


def _blocks(batches, block: int):
    """Record batches joined to tables of about ``block`` rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= block:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(t: pa.Table, name: str) -> pa.Array:
    c = t[name]
    return c.chunk(0) if c.num_chunks == 1 else c.combine_chunks()


def _assign(t: pa.Table, books: list, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(integers, codes, summed squared distances) of a block of rows."""
    x = _matrix(_column(t, "vec"), width * len(books))
    old = _column(t, "code")
    codes = np.zeros((t.num_rows, len(books)), np.uint8)
    errors = [0] * len(books)
    last = None if old.null_count else np.frombuffer(b"".join(old.to_pylist()), np.uint8).reshape(codes.shape)
    for p, entries in enumerate(books):
        part = x[:, p * width:(p + 1) * width]
        codes[:, p], errors[p] = nearest(part, entries) if last is None \
            else ball_nearest(part, entries, last[:, p].astype(np.int64))
    error = sum(e.astype(object) for e in errors) if any(e.dtype == object for e in errors) or \
        max(int(e.max(initial=0)) for e in errors) > LONG // len(books) else sum(errors)
    return x, codes, error


def _round(batches, books: list, width: int, block: int):
    """Rows with new codes, then this task's counts and sums per entry and component in limbs.

    ``entry`` numbers (part, entry, place), place ``width`` being the count.
    """
    sums: dict[int, int] = {}
    for t in _blocks(batches, block):
        x, codes, _ = _assign(t, books, width)
        for p in range(len(books)):
            part = x[:, p * width:(p + 1) * width]
            order = np.argsort(codes[:, p], kind="stable")
            found, first = np.unique(codes[order, p], return_index=True)
            exact = part.dtype == object or int(np.abs(part).max(initial=0)) > LONG // max(1, len(part))
            added = np.add.reduceat(part[order].astype(object) if exact else part[order], first, axis=0)
            n = np.diff(np.r_[first, len(order)])
            for e, row, c in zip(found.tolist(), added.tolist(), n.tolist()):
                for k, s in enumerate([*row, c]):
                    at = (p * ENTRIES + e) * (width + 1) + k
                    sums[at] = sums.get(at, 0) + int(s)
        code = pa.array([c.tobytes() for c in codes], pa.binary())
        empty = pa.nulls(t.num_rows, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [_column(t, "vec_id"), _column(t, "label"), _column(t, "vec"), code, empty, empty,
             pa.nulls(t.num_rows, pa.int64())], schema=_STATE)
    rows = []
    for at, s in sums.items():
        sign, s, limb = (1, s, 0) if s >= 0 else (-1, -s, 0)
        while s:
            rows.append((at, limb, sign * (s & ((1 << LIMB) - 1))))
            s, limb = s >> LIMB, limb + 1
    at, limb, s = zip(*rows) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(at), t) for _, t in _ROW] + [pa.array(at, pa.int32()), pa.array(limb, pa.int32()),
                                                   pa.array(s, pa.int64())], schema=_STATE)


def _moved(sums: DataFrame, books: list, width: int) -> list:
    """Codebooks with every used entry at the floor of its mean."""
    total: dict[int, int] = {}
    for r in sums.groupBy("entry", "limb").agg(F.sum("sums").alias("s")).collect():
        total[r["entry"]] = total.get(r["entry"], 0) + (r["s"] << (LIMB * r["limb"]))
    out = []
    for p, entries in enumerate(books):
        entries = entries.astype(object)
        for e in range(len(entries)):
            at = (p * ENTRIES + e) * (width + 1)
            if total.get(at + width):
                entries[e] = [total.get(at + k, 0) // total[at + width] for k in range(width)]
        out.append(entries)
    return out


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> tuple[list, int]:
    """(codebooks from the rows with the smallest ids, width of a part)."""
    longest = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    width = max(1, math.ceil(longest / parts))
    head = rows.select("vec_id", "vec").orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).collect()
    first = np.zeros((len(head), width * parts), object)
    for r, row in zip(first, head):
        r[:len(row["vec"])] = [int(x) for x in row["vec"]]
    return [first[:, p * width:(p + 1) * width] for p in range(parts)], width


def books_text(books: list) -> str:
    """All entries' integers by part, entry and place, joined by commas."""
    return ",".join(str(x) for entries in books for row in entries.tolist() for x in row)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding",
             label_col: str = "label") -> tuple[DataFrame, list]:
    """((vec_id, label, code, error), codebooks); ``code`` holds one byte per part."""
    if not 0 < entries <= ENTRIES:
        raise ValueError(f"entries must be 1 to {ENTRIES}")
    rows = written(integer_vectors(vectors, scale, id_col, vec_col, label_col), "vectors")
    books, width = first_codebooks(rows, parts, entries)
    state = rows.withColumn("code", F.lit(None).cast("binary"))

    def round_of(held: list):
        return lambda batches: _round(batches, held, width, block)

    for _ in range(rounds if books[0].size else 0):
        done = written(state.mapInArrow(round_of(books), _STATE_SQL)
                       .withColumn("is_sum", F.col("entry").isNotNull()), "codes", "is_sum")
        books = _moved(done.filter("is_sum"), books, width)
        state = done.filter("not is_sum").select("vec_id", "label", "vec", "code")

    def last(batches):
        for t in _blocks(batches, block):
            _, codes, error = _assign(t, books, width)
            yield pa.RecordBatch.from_arrays(
                [_column(t, "vec_id"), _column(t, "label"), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array([min(int(e), LONG) for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    return state.mapInArrow(last, "vec_id long, label string, code binary, error long"), books


def code_digest(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), codes as hex digits."""
    coded, books = compress(vectors, **options)
    coded = written(coded, "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("long")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    sha = hashlib.sha256(books_text(books).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))) \
        .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                F.lit(sha).alias("codebooks_sha256"))


def decoded(coded: DataFrame, books: list) -> DataFrame:
    """(vec_id, vec): the entries that each code stands for, as integers."""
    tables = [[[int(x) for x in row] for row in entries.tolist()] for entries in books]

    def back(batches):
        for b in batches:
            codes = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([[x for p, e in enumerate(c) for x in tables[p][e]] for c in codes],
                                       pa.list_(pa.int64()))], names=["vec_id", "vec"])

    return coded.select("vec_id", "code").mapInArrow(back, "vec_id long, vec array<long>")
