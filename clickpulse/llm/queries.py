"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm import (bpe, codes, divergence, lm, packing, quality, ranking, repeats, secret_scan, sharding, simhash,
                            token_files, topk)
from clickpulse.llm.common import table
from clickpulse.session import scratch_dir


def op1_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules: repetition coverage of every document."""
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op2_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate groups over vantage-point shards."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff log scores of every document against the rest of the corpus."""
    return lm.backoff_scores(table(spark, sf_dir, "documents"))


def op4_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that also start elsewhere."""
    return repeats.repeated_passages(table(spark, sf_dir, "documents"))


def op5_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents from pairwise preferences."""
    docs = table(spark, sf_dir, "documents")
    return ranking.score_documents(docs, ranking.train(docs, table(spark, sf_dir, "labels")))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and their decoding."""
    scheme = bpe.ByteBpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.byte_bpe_digest(table(spark, sf_dir, "documents"), scheme)


def op7_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 ids by minimum bin slack."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the shuffled shards of all documents (law ``rows``)."""
    text = F.coalesce("record.text", F.lit(""))
    digest = sharding.permuted(table(spark, sf_dir, "documents")).select(
        "bucket", "place", "record.doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.dealt(sharding.positions(digest), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector against all vectors."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op10_char_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base rules and the network's additions."""
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op11_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ in their words, and by which."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16-byte codes of all vectors by ball k-means codebooks."""
    return codes.code_digest(table(spark, sf_dir, "embeddings"))


def op13_token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as Parquet list columns and read back."""
    path = scratch_dir(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.token_digest(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_repetition_coverage, op2_simhash_vptree, op3_stupid_backoff, op4_difference_cover,
                             op5_bradley_terry, op6_byte_bpe, op7_min_bin_slack, op8_two_pass_shuffle, op9_histogram_topk, op10_char_cnn,
                             op11_level_products, op12_ball_kmeans, op13_token_lists)
}

_WORD = r"[^\x20\x09-\x0D]"


def _repetition_sql() -> str:
    """op1 in SQL: one grouping per n-gram length, windows over word positions."""
    limits = quality.NGRAM_LIMITS
    next_words = ", ".join(f"lead(word, {j}) OVER p AS w{j}" for j in range(1, max(limits)))
    grams = ", ".join(f"CASE WHEN w{k - 1} IS NOT NULL THEN concat_ws(' ', word, "
                      f"{', '.join(f'w{j}' for j in range(1, k))}) END AS g{k}" for k in limits)  # words hold no spaces
    firsts = ", ".join(f"f{k} AS (SELECT doc_id, g{k} AS g, min(i) AS first, count(*) AS c FROM g "
                       f"WHERE g{k} IS NOT NULL GROUP BY doc_id, g{k})" for k in limits)
    joins = " ".join(f"LEFT JOIN f{k} ON g.doc_id = f{k}.doc_id AND g{k} = f{k}.g" for k in limits)
    later = ", ".join(f"f{k}.first < i AS r{k}" for k in limits)
    per_word = ", ".join(
        f"max(CASE WHEN r{k} THEN 1 ELSE 0 END) OVER (p ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS d{k}"
        for k in limits)
    n = quality.BASE_LENGTH
    sums = ", ".join(f"CAST(coalesce(sum(length(word)) FILTER (d{k} = 1), 0) AS BIGINT) AS dup_{k}gram_chars" for k in limits)
    bad = " OR ".join(f"100 * dup_{k}gram_chars > {v} * word_chars" for k, v in limits.items())
    outs = ", ".join(f"dup_{k}gram_chars" for k in limits)
    zero = ", ".join(f"coalesce(dup_{k}gram_chars, 0) AS dup_{k}gram_chars" for k in limits)
    return f"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        s AS (SELECT doc_id, regexp_extract_all(text, '{_WORD}+') AS l FROM t),
        u AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS i FROM s),
        q AS (SELECT doc_id, word, i, {next_words} FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
        g AS (SELECT doc_id, word, i, {grams} FROM q),
        {firsts},
        r AS (SELECT g.doc_id, word, i, {later}, f{n}.c AS c FROM g {joins}),
        c AS (SELECT doc_id, word, {per_word},
                     max(CASE WHEN c > 1 THEN 1 ELSE 0 END) OVER (p ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS e
              FROM r WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
        w AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars,
                     CAST(sum(e) AS BIGINT) AS n_repeat_words, {sums}
              FROM c GROUP BY doc_id),
        x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
        y AS (SELECT doc_id, line, count(*) - 1 AS later FROM x WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id, line),
        z AS (SELECT doc_id, CAST(sum(later) AS BIGINT) AS n_dup_lines, CAST(sum(later * length(
                     regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS BIGINT) AS dup_line_chars FROM y GROUP BY doc_id),
        m AS (SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
                     CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                     coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                     coalesce(dup_line_chars, 0) AS dup_line_chars, {zero}
              FROM t LEFT JOIN w ON t.doc_id = w.doc_id LEFT JOIN z ON t.doc_id = z.doc_id),
        b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.BASE_LIMIT} * n_words AS base_failed
              FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 100 * dup_line_chars > {quality.LINE_LIMIT} * word_chars OR {bad}) AS kept,
               dup_line_chars, {outs}
        FROM b"""


def _divergence_sql() -> str:
    """op11 in SQL: prices of every term in every group, groups of a language joined term by term."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
        WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS k,
                          translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
        g AS (SELECT DISTINCT lang, source FROM d),
        o AS (SELECT lang, source, k, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
              FROM d),
        kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT k) >= {divergence.MIN_DOCS}),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term)
              GROUP BY lang, source, term),
        t AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g
              LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
        p AS (SELECT t.lang, t.source, kept.term, coalesce(n, 0) AS n,
                     1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2) // (total + 2 * v) AS p
              FROM t JOIN v USING (lang) JOIN kept USING (lang)
              LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = kept.term),
        l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
        q AS (SELECT l.lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (sum(n) OVER (PARTITION BY l.lang) + 2 * v)
                     AS q FROM l JOIN v USING (lang)),
        j AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
              GROUP BY a.lang, a.source, b.source),
        u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN j ON j.lang = a.lang AND j.source = a.source AND j.item = b.source
              UNION ALL
              SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT)
              FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER)
                     AS rank FROM u)
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def _codes_sql(width: int = 4) -> str:
    """op12 in SQL for vectors of 16 x ``width`` components: all distances, three times."""
    steps = []
    for k in range(codes.ROUNDS + 1):
        steps.append(f"""
        a{k} AS MATERIALIZED (
            SELECT i, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
            FROM (SELECT x.i, x.part, e.entry, CAST(list_sum(list_transform(list_zip(x.v, e.v),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
                  FROM x JOIN b{k} e ON x.part = e.part) GROUP BY i, part)""")
        if k < codes.ROUNDS:
            steps.append(f"""
        s{k} AS (SELECT x.part, entry, j, CAST(sum(x.v[j]) AS HUGEINT) AS s, count(*) AS n
                 FROM x JOIN a{k} USING (i, part), range(1, {width + 1}) t(j) GROUP BY x.part, entry, j),
        m{k} AS (SELECT part, entry, list(CAST(s // n - CASE WHEN s < 0 AND s % n <> 0 THEN 1 ELSE 0 END AS BIGINT)
                                          ORDER BY j) AS v FROM s{k} GROUP BY part, entry),
        b{k + 1} AS MATERIALIZED (SELECT e.part, e.entry, coalesce(m.v, e.v) AS v
                                  FROM b{k} e LEFT JOIN m{k} m USING (part, entry))""")
    n = codes.ROUNDS
    return f"""
        WITH r AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label, list_transform(embedding,
                   lambda x: CAST(floor({codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        x AS MATERIALIZED (SELECT i, part, q[{width} * part + 1:{width} * part + {width}] AS v
                           FROM r, range({codes.PARTS}) t(part)),
        b0 AS MATERIALIZED (SELECT part, i - 1 AS entry, v FROM x WHERE i <= {codes.ENTRIES}),{",".join(steps)},
        o AS (SELECT i, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code,
                     CAST(sum(d) AS BIGINT) AS error FROM a{n} GROUP BY i),
        h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS sha FROM b{n})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               sha AS codebooks_sha256
        FROM o JOIN r USING (i), h"""


ORACLE: dict[str, str] = {
    "op11_level_products": _divergence_sql(),
    "op12_ball_kmeans": _codes_sql(),
    "op1_repetition_coverage": _repetition_sql(),
    "op9_histogram_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
        r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
                   AS rank, vec_id, score
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
