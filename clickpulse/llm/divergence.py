"""Source divergence audit by one-hot level products (op11).

How differently do the sources of a language use its words? Every (language,
source) group gives each kept term a price p = 1 + floor(10^9 (count + 2) / (N + 2 V)),
V being the number of terms in at least ``MIN_DOCS`` documents of the language and N
the group's occurrences of them. Two groups differ by the sum over all V terms of
floor((p - q)^2 / (p + q)), a group differs from its language term by term.

1. Counts. Each task counts the terms of its documents per group and sends one row per
   group and term; one shuffle by (language, term) adds them up, finds the number of
   documents and of all occurrences, and drops rare terms.
2. Products. The terms of a language are dealt into blocks by hash, its groups likewise,
   and a cell holds one block of terms for two blocks of groups. In a cell a term has in
   each group a level, its count there (0 included). Steps of similar terms become a 0/1
   matrix with a column per (group, level); its transpose times itself is the joint table
   of every pair of groups: how many terms have level a here and level b there. Counts in
   a product stay far below 2^24, so float32 is exact.
3. Pricing. An entry of a joint table is priced once for all its terms; terms that no
   group of a cell has are the entry (0, 0), whose number follows from V.

Defined results: null texts, languages and sources are ''; groups without kept terms are
listed with value 0 where V is 0; equal rows count each; extra columns are ignored; an
empty table gives an empty result. All arithmetic is on integers: 64 bits hold values and
counts below 9 * 10^18, the price of a count is taken by decimals. A worker holds one
text three times (about 70 bytes more per distinct word of the rows counted together) or
one cell, whichever is larger.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickpulse.llm.common import text_bytes, written

MIN_DOCS = 10         # documents of a language that must hold a kept term
TOP_TERMS = 10        # ranks of the part ``term``
TERM_BLOCK = 4096     # terms of a cell, about
GROUP_BLOCK = 24      # groups of a block, about; a cell has two blocks
STEP = 128            # terms of one product
HELD = 300_000        # counts a task holds before it sends them on
PIECE = 1 << 20       # bytes of a text split at once

# A-Z become a-z; other ASCII bytes than letters separate terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("n", pa.int64()), ("docs", pa.int64())])
_PAIRS = "lang string, source string, item string, value long, terms long, none long, v long"


def _pieces(raw: bytes):
    """Lists of the terms of a text, about ``PIECE`` bytes each."""
    clean, at = raw.translate(_TERM_BYTES), 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def _rows(counts: dict, docs: dict) -> pa.RecordBatch:
    columns = [[], [], [], [], []]
    for (lang, source), terms in counts.items():
        held = docs[lang, source]
        for column, more in zip(columns, ([lang] * len(terms), [source] * len(terms), [t.decode() for t in terms],
                                          terms.values(), [held[t] for t in terms])):
            column.extend(more)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTS)], schema=_COUNTS)


def _count(batches):
    """(lang, source, term, n, docs) of the rows counted together."""
    counts, docs, held = {}, {}, 0
    for batch in batches:
        offsets, data = text_bytes(batch.column(2))
        groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for group, i, j in zip(groups, offsets[:-1].tolist(), offsets[1:].tolist()):
            n, d, own = counts.setdefault(group, Counter()), docs.setdefault(group, Counter()), set()
            before = len(n)
            for terms in _pieces(data[i:j].tobytes()):
                n.update(terms)
                own.update(terms)
            d.update(own)
            held += len(n) - before
            if held > HELD:
                yield _rows(counts, docs)
                counts, docs, held = {}, {}, 0
    yield _rows(counts, docs)


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, lang_n, first): occurrences of kept terms in each group that has them.

    ``lang_n`` are those of the whole language; ``first`` marks one row per (lang, term).
    """
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                          for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    term = W.partitionBy("lang", "term")
    return texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long") \
        .repartition("lang", "term").groupBy("lang", "term", "source") \
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")) \
        .withColumn("all_docs", F.sum("docs").over(term)).filter(F.col("all_docs") >= min_docs) \
        .select("lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"),
                (F.col("source") == F.min("source").over(term)).alias("first"))


def _price(count: str, total: str) -> F.Column:
    """1 + floor(10^9 (count + 2) / (total + 2 v)), null without kept terms."""
    return F.expr(f"case when v > 0 then 1 + (cast(1000000000 as decimal(10,0)) * cast({count} + 2 as decimal(20,0))"
                  f" div cast({total} + 2 * v as decimal(20,0))) end").cast("long")


def _differ(p, q):
    """floor((p - q)^2 / (p + q)) of integers of at most 10^9 + 1."""
    return (p - q) ** 2 // (p + q)


def _products(keys: np.ndarray, prices: np.ndarray, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """Sums over terms of the differences of groups ``left`` x ``right``.

    ``keys`` (terms x groups) are levels, made distinct between groups; ``prices`` theirs.
    """
    total = np.zeros((len(left), len(right)), np.int64)
    row_of, column_of = np.full(keys.shape[1], -1), np.full(keys.shape[1], -1)
    row_of[left], column_of[right] = np.arange(len(left)), np.arange(len(right))
    for at in range(0, len(keys), step):
        block = keys[at:at + step]
        _, first, level = np.unique(block, return_index=True, return_inverse=True)
        group, price = first % keys.shape[1], prices[at:at + step].ravel()[first]
        hot = np.zeros((len(block), len(first)), np.float32)
        np.put_along_axis(hot, level.reshape(block.shape), 1, axis=1)
        a, b = np.flatnonzero(row_of[group] >= 0), np.flatnonzero(column_of[group] >= 0)
        joint = hot[:, a].T @ hot[:, b]
        i, j = np.nonzero(joint)
        value = joint[i, j].astype(np.int64) * _differ(price[a[i]], price[b[j]])
        np.add.at(total, (row_of[group[a[i]]], column_of[group[b[j]]]), value)
    return total


def _cell(t: pa.Table, step: int) -> pa.Table:
    """Sums of one block of terms for all pairs of two blocks of groups."""
    head = t.filter(t["term"].is_null())
    sources, zero = head["source"].to_pylist(), head["p"].to_numpy()
    block, i, j = head["block"].to_numpy(), head["i"][0].as_py(), head["j"][0].as_py()
    v, lang = head["v"][0].as_py(), head["lang"][0].as_py()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    body = t.filter(t["term"].is_valid())
    terms = body["term"].combine_chunks().dictionary_encode()
    number = {s: k for k, s in enumerate(sources)}
    place = body["source"].combine_chunks().dictionary_encode()
    at = (terms.indices.to_numpy(), np.array([number[s] for s in place.dictionary.to_pylist()], np.int64)[
        place.indices.to_numpy()] if body.num_rows else np.zeros(0, np.int64))
    levels = np.zeros((len(terms.dictionary), len(sources)), np.int64)
    prices = np.tile(zero, (len(terms.dictionary), 1))
    levels[at], prices[at] = body["n"].to_numpy(), body["p"].to_numpy()
    order = np.argsort(levels.sum(axis=1), kind="stable")  # similar terms share levels
    keys = levels[order] * len(sources) + np.arange(len(sources))
    sums = _products(keys, prices[order], left, right, step)
    none = _differ(zero[left, None], zero[None, right])
    g, h = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
    sums, none, pick = sums.ravel(), none.ravel(), g != h
    if i != j:
        g, h, sums, none, pick = np.r_[g, h], np.r_[h, g], np.r_[sums, sums], np.r_[none, none], np.r_[pick, pick]
    g, h, sums, none = g[pick], h[pick], sums[pick], none[pick]
    names = pa.array(sources, pa.string())
    same = lambda x: pa.array(np.full(len(g), x, np.int64))
    return pa.table({"lang": pa.array([lang] * len(g), pa.string()), "source": names.take(pa.array(g)),
                     "item": names.take(pa.array(h)), "value": pa.array(sums), "terms": same(len(terms.dictionary)),
                     "none": pa.array(none), "v": same(v)})


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, term_block: int = TERM_BLOCK,
               group_block: int = GROUP_BLOCK, step: int = STEP, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups, see the module's head.

    Part ``pair``: every other source of the language, largest difference first; part
    ``term``: the ``top_terms`` terms that the group uses more than its language.
    """
    counts = written(term_counts(docs, min_docs, text_col, lang_col, source_col), "term-counts")
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                           for c, a in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    in_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    in_lang = counts.groupBy("lang").agg(F.sum("n").alias("all_n"), F.count(F.when(F.col("first"), 1)).alias("v"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n_groups"))
    groups = written(
        groups.join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left").join(sizes, "lang")
        .fillna(0, ["group_n", "all_n", "v"])
        .select("*", _price("0", "group_n").alias("p0"),
                F.greatest(F.ceil(F.col("v") / term_block), F.lit(1)).cast("int").alias("term_blocks"),
                F.ceil(F.col("n_groups") / group_block).cast("int").alias("group_blocks"))
        .withColumn("block", F.expr("cast(pmod(xxhash64(source), group_blocks) as int)")), "groups")
    priced = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "v", "block", "group_blocks", _price("n", "group_n").alias("p"),
        _price("lang_n", "all_n").alias("q"),
        F.expr("cast(pmod(xxhash64(term), term_blocks) as int)").alias("term_block"))

    heads = groups.filter("n_groups > 1").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "v", "block",
        "group_blocks", F.coalesce("p0", F.lit(1)).alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("term_block"))
    cells = priced.drop("q").unionByName(heads) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1))) \
        .select("lang", "source", "term", "n", "p", "v", "block", "term_block", F.least("block", "other").alias("i"),
                F.greatest("block", "other").alias("j"))

    def cell(t: pa.Table) -> pa.Table:
        # a cell without groups of one side, or the terms of a language with one source, has no pairs
        sound = t["term"].null_count > 0
        return _cell(t, step) if sound else pa.schema(
            [(n, pa.string()) for n in ("lang", "source", "item")]
            + [(n, pa.int64()) for n in ("value", "terms", "none", "v")]).empty_table()

    pairs = cells.groupBy("lang", "term_block", "i", "j").applyInArrow(cell, _PAIRS) \
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"),
                                               F.max("none").alias("none"), F.max("v").alias("v")) \
        .select("lang", "source", F.lit("pair").alias("part"), "item",
                (F.col("value") + (F.col("v") - F.col("terms")) * F.col("none")).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = priced.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          F.expr("(p - q) * (p - q) div (p + q)").alias("value")) \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    return pairs.unionByName(terms)
