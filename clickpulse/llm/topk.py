"""Exact top-k search by distributed histogram selection (op9).

Vectors are integers (each component floor(scale * x)); a score is an inner
product. Queries and candidates are dealt to a grid of cells, each holding at
most about ``CELL_QUERIES`` x ``CELL_ROWS``, and every cell scores its block.
Each round sums, over all cells, a histogram of 256 bins per query over the
range that holds its k-th highest score, and narrows the range to one bin; when
a bin is one score wide it is the k-th value. A cell sends its bins from the top
only as far as its own k-th score, which is never below the global one's bin.
A last pass keeps scores at or above the k-th value, at most k a cell and query,
and ranks them, ties to the smaller id.

Vectors that are null or hold a null, NaN or infinite component take no part.
Shorter vectors count as padded with zeros. A query's own row is left out, with
any other row of its id; repeated query rows give one result list, repeated
candidate rows are candidates each. Rows without an id are no queries and, as
candidates, come last among ties. Scores of any components are computed exactly
(Python integers for rows with components too large for 64-bit products) and given up
to 2^63 - 1 in magnitude: a score beyond is that bound, and ties there go to the smaller
id. A component of 2^1015 or more in magnitude counts as infinite. An empty table gives
an empty result, and fewer than k candidates are all returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickpulse.llm.common import written

K = 20
SCALE = 64
BINS = 256
CELL_ROWS = 16_384
CELL_QUERIES = 2_048
STEP = 128  # queries scored at once in a cell
LONG = (1 << 63) - 1
LARGEST = 2.0 ** 1015


def _vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, vec array<double> of whole numbers) of the rows that take part."""
    # beyond 2^44 the product is whole already (doubles have 53 bits), and floor() might leave 64 bits
    whole = F.transform(F.col(vec_col), lambda x: F.when(
        F.abs(x.cast("double")) < float(1 << 44), F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
        .otherwise(F.lit(float(scale)) * x.cast("double")))
    sound = F.col(vec_col).isNotNull() & F.forall(
        F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST))
    picked = df.select(F.col(id_col).cast("long").alias("id"), vec_col).filter(F.coalesce(sound, F.lit(False)))
    return picked.select("id", whole.alias("vec"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks()
    out = np.zeros((len(column), width))
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    if len(lengths) and (lengths == width).all():
        out[:] = flat[offsets[0]:offsets[-1]].reshape(-1, width)
    else:
        rows = np.repeat(np.arange(len(column)), lengths)
        out[rows, np.arange(len(rows)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = flat[offsets[0]:offsets[-1]]
    return out


def _large(vectors: np.ndarray) -> np.ndarray:
    """Rows whose products may exceed 64 bits, whatever they are multiplied with."""
    return (np.abs(vectors) > math.isqrt((1 << 62) // max(1, vectors.shape[1]))).any(axis=1)


def _products(q: np.ndarray, c: np.ndarray, exact_float: bool) -> np.ndarray:
    """Inner products of whole numbers as 64-bit integers, at most ``LONG`` in magnitude."""
    if exact_float:
        return (q @ c.T).astype(np.int64)
    ql, cl = _large(q), _large(c)
    small = lambda x, large: np.where(large[:, None], 0, x).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)
    out = small(q, ql) @ small(c, cl).T
    for rows, at in ((np.flatnonzero(ql), np.arange(len(c))), (np.arange(len(q)), np.flatnonzero(cl))):
        if len(rows) and len(at):
            exact = whole(q[rows]) @ whole(c[at]).T
            out[np.ix_(rows, at)] = np.clip(exact, -LONG, LONG).astype(np.int64)
    return out


def _cell(t: pa.Table, width: int, exact_float: bool):
    """(queries, candidate ids and matrix) of one cell, queries in steps with their scores."""
    mark = t["is_query"].to_numpy()
    q, c = t.filter(pa.array(mark)), t.filter(pa.array(~mark))
    # candidate ids: none sorts last and equals no query
    ids = c["id"].combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy()
    none = c["id"].is_null().to_numpy()
    order = np.lexsort((ids, none))
    ids, none = ids[order], none[order]
    rows = _matrix(c["vec"], width)[order]
    qv = _matrix(q["vec"], width)
    qid, qkey, lo, need = (q[x].to_numpy() for x in ("id", "qkey", "lo", "need"))
    for i in range(0, len(qid) if len(ids) else 0, STEP):
        scores = _products(qv[i:i + STEP], rows, exact_float)
        own = (qid[i:i + STEP, None] == ids[None, :]) & ~none
        yield qid[i:i + STEP], qkey[i:i + STEP], lo[i:i + STEP], need[i:i + STEP], ids, none, scores, own


def _histogram(t: pa.Table, width: int, exact_float: bool, bin_width: int) -> pa.Table:
    keys, bins, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, qkey, lo, need, _, _, scores, own in _cell(t, width, exact_float):
        # unsigned: the range may span all 64 bits
        away = (scores.view(np.uint64) - lo[:, None].view(np.uint64)) // np.uint64(bin_width)
        use = ~own & (scores >= lo[:, None]) & (away < BINS)
        at = np.where(use, away, 0).astype(np.int64) + np.arange(len(qkey))[:, None] * BINS
        hist = np.bincount(at[use], minlength=len(qkey) * BINS).reshape(len(qkey), BINS)
        above = hist[:, ::-1].cumsum(axis=1)[:, ::-1] - hist  # scores in higher bins
        r, b = np.nonzero((hist > 0) & (above < need[:, None]))
        keys.append(qkey[r])
        bins.append(b)
        counts.append(hist[r, b])
    return pa.table({"qkey": np.concatenate(keys), "bin": np.concatenate(bins), "n": np.concatenate(counts)})


def _highest(t: pa.Table, width: int, exact_float: bool, k: int) -> pa.Table:
    parts = []
    for qid, qkey, lo, _, ids, none, scores, own in _cell(t, width, exact_float):
        r, c = np.nonzero(~own & (scores >= lo[:, None]))
        s = scores[r, c]
        order = np.lexsort((c, -s, r))  # candidates lie in id order
        r, c, s = r[order], c[order], s[order]
        first = np.searchsorted(r, np.arange(len(qid)))
        best = np.arange(len(r)) - first[r] < k
        r, c, s = r[best], c[best], s[best]
        parts.append(pa.table({"qkey": qkey[r], "query_id": qid[r],
                               "vec_id": pa.array(ids[c], mask=none[c]), "score": s}))
    kinds = pa.schema([("qkey", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    return pa.concat_tables(parts) if parts else kinds.empty_table()


def _raised(bin_width: int) -> F.Column:
    """The lower end of the bin found, as a long; a bin times its width may exceed one."""
    step = F.coalesce("bin", F.lit(0)).cast("decimal(3,0)") * F.lit(bin_width).cast("decimal(20,0)")
    return (F.col("lo").cast("decimal(20,0)") + step).cast("long")


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row with ``is_query``.

    ``is_query`` is a condition on the column ``id``; all rows are candidates.
    """
    rows = written(_vectors(vectors, id_col, vec_col, scale), "vectors")
    asked = F.col("id").isNotNull() & is_query
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    n, n_queries, width, most, norm_all, norm_q = rows.agg(
        F.count("*"), F.count(F.when(asked, 1)), F.max(F.size("vec")),
        F.max(F.array_max(F.transform("vec", F.abs))), F.max(norm), F.max(F.when(asked, norm))).first()
    width, most = width or 0, most or 0
    reach = math.sqrt(norm_all or 0.0) * math.sqrt(norm_q or 0.0) * (1 + 1e-9) + 1
    bound = int(reach) + 1 if reach < LONG else LONG
    exact_float = width * most * most < 1 << 53
    parts, blocks = max(1, math.ceil(n / CELL_ROWS)), max(1, math.ceil(n_queries / CELL_QUERIES))

    place = F.monotonically_increasing_id()
    part = F.pmod(F.xxhash64(place), F.lit(parts))
    candidates = rows.select("id", "vec", part.alias("part")) \
        .select("id", "vec", "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")) \
        .withColumn("is_query", F.lit(False))
    queries = rows.filter(asked).select("id", "vec", F.xxhash64("id", "vec").alias("qkey")).distinct()

    def cells(state: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("qkey"), F.lit(blocks)).cast("int")
        mine = state.select("id", "vec", "qkey", "lo", "need", block.alias("block")) \
            .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")) \
            .withColumn("is_query", F.lit(True))
        return candidates.unionByName(mine, allowMissingColumns=True).groupBy("part", "block")

    def count_bins(bin_width: int):
        return lambda t: _histogram(t, width, exact_float, bin_width)

    rounds = max(1, math.ceil(math.log(2 * bound + 1) / math.log(BINS)))
    rounds += BINS ** rounds < 2 * bound + 1
    state = queries.select("*", F.lit(-bound).cast("long").alias("lo"), F.lit(k).cast("long").alias("need"))
    for i in reversed(range(rounds)):
        w = BINS ** i
        state = written(state, "state")
        bins = cells(state).applyInArrow(count_bins(w), "qkey long, bin long, n long")
        down = W.partitionBy("qkey").orderBy(F.desc("bin"))
        sums = bins.groupBy("qkey", "bin").agg(F.sum("n").alias("n")) \
            .withColumn("upto", F.sum("n").over(down)).withColumn("above", F.col("upto") - F.col("n"))
        hit = state.select("qkey", "need").join(sums, "qkey").filter("above < need and upto >= need") \
            .select("qkey", "bin", "above")
        # too few candidates: the lowest bin, so that all of them pass in the end
        state = state.join(hit, "qkey", "left").select(
            "id", "vec", "qkey", _raised(w).alias("lo"),
            (F.col("need") - F.coalesce("above", F.lit(0))).alias("need"))
    best = cells(written(state, "state")).applyInArrow(
        lambda t: _highest(t, width, exact_float, k), "qkey long, query_id long, vec_id long, score long")
    order = W.partitionBy("query_id", "qkey").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
