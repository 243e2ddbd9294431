"""Token ids as Parquet files with list columns (op13).

Documents are ranged by id into as many sorted partitions as files are wanted, encoded
there and written, so that the files in name order hold the documents in ascending id
order. The texts are shuffled once and encoded once. A folder holds

* ``tokens/``: per document doc_id, meta (columns asked for), part (the file's number),
  local_start (ids before it in its file), n_tokens, ids (list of integers, dictionary or
  delta encoded; the plain columns are delta encoded). Row groups and pages have set
  sizes, and Spark's writer adds the page indexes.
* ``index/``: per file its first and last id, rows, tokens and the ids of all files before.

Readers take what they need: :func:`metadata` never touches the list column,
:func:`documents` pushes a range of ids to row group statistics and page indexes,
:func:`tokens_between` finds the files of a range of token positions in the index first.

Texts are cut into pre-tokens a run of about ``PIECE`` bytes at a time, by the classes of
their characters. The different pre-tokens of about ``BLOCK_BYTES`` of text are looked up
together among those that the worker has met in this task or an earlier one, in Arrow arrays;
only new ones are encoded. At most ``KNOWN`` are held besides a block's; beyond that those of
the latest block stay.
Defined results: a null text is empty, so the end id is its only one; null ids come
first; rows with equal ids lie in the order of a hash of their texts, equal rows count
each; strings of special tokens in a text are ordinary text; other columns than those
named in ``meta`` are left out, and ``meta`` is a struct, so its names cannot clash; an
empty table gives a folder without documents. A worker holds one batch of texts or one
long text with its ids (about 10 bytes per byte of it; long texts are split in pieces), besides
the pre-tokens' numbers of a block.
"""

from __future__ import annotations

import functools
import math
import os
import re
import zlib
from array import array
from collections import deque
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from clickpulse.llm.bpe import ByteBpe, _binary, _joined, _release, _slices
from clickpulse.llm.common import runs, text_bytes

END_ID = 2
FILE_TEXT_BYTES = 64 << 20   # text of one file, about
ROW_GROUP_BYTES = 16 << 20   # buffered bytes of a row group
PAGE_BYTES = 256 << 10
PAGE_ROWS = 512              # a page holds at most so many documents
PIECE = 1 << 20              # bytes of texts split at once
BLOCK_BYTES = 8 << 20        # text whose pre-tokens are looked up at once
KNOWN = 600_000              # pre-tokens whose ids a worker holds
PARTS_PER_BLOCK = 1024       # files whose offsets are added up at once
# A space between two ASCII letters always starts a pre-token.
_CUT = re.compile(rb"[A-Za-z] (?=[A-Za-z])")
ENCODINGS = ("dictionary", "delta")


def _pieces(raw: bytes):
    """The text in pieces of about ``PIECE`` bytes that begin where a pre-token does."""
    at = 0
    while len(raw) - at > PIECE:
        cut = _CUT.search(raw, at + PIECE)
        if cut is None:
            break
        yield raw[at:cut.start() + 1]
        at = cut.start() + 1
    yield raw[at:] if at else raw


class Run(NamedTuple):
    """Texts, or a piece of one, cut into pre-tokens."""

    rows: int                    # texts of the item that the run is of
    first: int                   # its texts, from this one
    last: int                    # to the one before this
    size: int                    # bytes
    words: pa.LargeBinaryArray   # its different pre-tokens
    codes: np.ndarray            # number in ``words`` of each pre-token
    upto: np.ndarray             # pre-tokens before each text and of all
    whole: bool                  # whether its last text ends here


class Encoder:
    """Ids of texts by a ``tokenizers`` file of the byte-level kind.

    The pre-tokens met (``words``) and their ids (``found``, four bytes each) are held, so that each is encoded once.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer
        coder = Tokenizer.from_file(file)
        self.tokenize = coder.model.tokenize  # special tokens are not looked for
        scheme = ByteBpe("")
        self.split, self.starts = scheme.splitter(), scheme.cutter()
        # byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100
        self.alphabet = {b: chr(b) for b in range(256) if chr(b).isprintable() and b != 0x20}
        self.alphabet |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in self.alphabet)}
        self.words = self.found = pa.array([], pa.large_binary())

    def _encoded(self, word: bytes) -> bytes:
        mapped = word.decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenize(mapped)]).tobytes()

    def look_up(self, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The ids of each pre-token; those not met before are encoded."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null()).dictionary_encode()
        number = at.fill_null(-1).to_numpy().copy()
        number[number < 0] = len(self.words) + new.indices.to_numpy()
        ids = pa.array([self._encoded(w) for some in _slices(new.dictionary) for w in some], pa.large_binary())
        self.words, self.found = pa.concat_arrays([self.words, new.dictionary]), pa.concat_arrays([self.found, ids])
        out = self.found.take(pa.array(number))
        if len(self.words) > KNOWN:
            kept = pa.array(np.unique(number))
            self.words, self.found = self.words.take(kept), self.found.take(kept)
        _release()
        return out

    def _cut(self, texts):
        """The runs of each item of ``texts``."""
        for offsets, data in texts:
            rows = len(offsets) - 1
            for i, j in runs(offsets, PIECE):
                here, raw = offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]]
                left = len(raw)
                for piece in [raw] if left <= PIECE else _pieces(raw.tobytes()):
                    left -= len(piece)
                    if len(piece) > 2 * PIECE:  # no place to cut: arrays of its characters would be large
                        coded = pa.array(map(str.encode, self.split(piece)), pa.large_binary()).dictionary_encode()
                        upto = np.array([0, len(coded)])
                    else:
                        chars = np.frombuffer(piece, np.uint8)
                        ends = here if len(chars) == len(raw) else np.array([0, len(chars)])
                        begin = self.starts(ends, chars)
                        coded = _binary(np.r_[begin, len(chars)], chars).dictionary_encode()
                        upto = np.searchsorted(begin, ends)
                    yield Run(rows, i, j, len(piece), coded.dictionary, coded.indices.to_numpy(), upto, not left)

    def _joined(self, held: list[Run], end: bytes):
        """(run, bytes of ids of each of its texts, ids one after another) of the runs of a block."""
        found, k = self.look_up(pa.concat_arrays([run.words for run in held])), 0
        for run in held:
            n, upto, codes = len(run.words), run.upto, run.codes
            ids = pa.concat_arrays([found.slice(k, n), pa.array([end], pa.large_binary())])
            if run.whole:
                codes, upto = np.insert(codes, upto[1:], n), upto + np.arange(len(upto))
            ends, flat = _joined(ids, upto, codes)
            yield run, np.diff(ends), flat[:ends[-1]]
            k += n

    def _blocks(self, cut):
        held, size = [], 0
        for run in cut:
            held.append(run)
            size += run.size
            if size >= BLOCK_BYTES:
                yield held
                held, size = [], 0
        if held:
            yield held

    def texts(self, texts, end: bytes):
        """(ids before each text and of all, ids one after another) of each item of ``texts``.

        An item holds the offsets and bytes of a text or more; ``end`` comes after each text.
        """
        n, parts = None, []
        for held in self._blocks(self._cut(texts)):
            for run, sizes, flat in self._joined(held, end):
                n = np.zeros(run.rows, np.int64) if n is None else n
                n[run.first:run.last] += sizes
                parts.append(flat)
                if run.whole and run.last == run.rows:
                    yield np.r_[0, np.cumsum(n)] // 4, np.concatenate(parts).view(np.int32)
                    n, parts = None, []

    def ids(self, raw: bytes) -> bytes:
        """The ids of a whole text, four bytes each."""
        (_, flat), = self.texts([(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))], b"")
        return flat.tobytes()


@functools.lru_cache(maxsize=1)
def _encoder(file: str, changed: int) -> Encoder:
    """The encoder that the tasks of a worker share."""
    return Encoder(file)


def _encode(batches, file: str, end_id: int):
    """(doc_id, meta, part, local_start, n_tokens, ids) of the documents of one file, in their order."""
    encoder, part, at = _encoder(file, os.stat(file).st_mtime_ns), TaskContext.get().partitionId(), 0
    held = deque()

    def texts():
        for batch in batches:
            if batch.num_rows:
                every = pa.array(np.arange(batch.num_rows))
                held.append([batch.column(k).take(every) for k in (0, 1)])  # copies: the texts are let go
                yield text_bytes(batch.column(2))

    for ends, flat in encoder.texts(texts(), array("I", [end_id]).tobytes()):
        doc_id, meta = held.popleft()
        n = np.diff(ends)
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays(
            [doc_id, meta, pa.array(np.full(len(n), part, np.int32)), pa.array(at + ends[:-1]), pa.array(n), ids],
            names=["doc_id", "meta", "part", "local_start", "n_tokens", "ids"])
        at += int(ends[-1])


def write_tokens(docs: DataFrame, path: str, file: str, end_id: int = END_ID, meta: tuple[str, ...] = (),
                 encoding: str = "dictionary", file_text_bytes: int = FILE_TEXT_BYTES,
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of all documents and their index under ``path``."""
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}: {encoding}")
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    files = max(1, math.ceil(total / file_text_bytes))
    # no column asked for: a struct without fields cannot be written
    kept = F.struct(*[F.col(c) for c in meta]) if meta else F.struct(F.lit(None).cast("boolean").alias("none"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), kept.alias("meta"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # rows of one id are told apart by their texts, equal rows by their place in the input
    order = [F.asc_nulls_first("doc_id"), "_hash", "_place"]
    ranged = rows.select("*", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place"))
    ranged = ranged.repartitionByRange(files, *order).sortWithinPartitions(*order)
    schema = T.StructType([ranged.schema["doc_id"], ranged.schema["meta"], T.StructField("part", T.IntegerType()),
                           T.StructField("local_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    ranged.select("doc_id", "meta", "text").mapInArrow(lambda b: _encode(b, file, end_id), schema).write \
        .option("compression", "zstd").option("parquet.writer.version", "v2") \
        .option("parquet.enable.dictionary", "false") \
        .option("parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower()) \
        .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes) \
        .option("parquet.page.row.count.limit", page_rows).parquet(f"{path}/tokens")
    spark = docs.sparkSession
    per_file = spark.read.schema(schema).parquet(f"{path}/tokens").groupBy("part").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n_rows"),
        F.sum("n_tokens").alias("n_tokens"))
    _offsets(per_file).write.parquet(f"{path}/index")


def _offsets(per_file: DataFrame) -> DataFrame:
    """``per_file`` with the tokens of all files before; added up in blocks of files."""
    block = F.floor(F.col("part") / PARTS_PER_BLOCK)
    inner = per_file.withColumn("block", block).withColumn(
        "in_block", F.coalesce(F.sum("n_tokens").over(W.partitionBy("block").orderBy("part").rowsBetween(
            W.unboundedPreceding, -1)), F.lit(0)))
    # one row per PARTS_PER_BLOCK files
    blocks = inner.groupBy("block").agg(F.sum("n_tokens").alias("n")).withColumn(
        "ahead", F.coalesce(F.sum("n").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return inner.join(blocks, "block").select("part", "first_id", "last_id", "n_rows", "n_tokens",
                                              (F.col("ahead") + F.col("in_block")).alias("offset"))


def index(spark: SparkSession, path: str) -> DataFrame:
    """(part, first_id, last_id, n_rows, n_tokens, offset) of every file."""
    return spark.read.parquet(f"{path}/index")


def documents(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None,
              columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """(doc_id, start, n_tokens, *columns) of the documents in a range of ids, both ends included."""
    rows = spark.read.parquet(f"{path}/tokens")
    files = index(spark, path)
    if first_id is not None:
        rows, files = rows.filter(F.col("doc_id") >= first_id), files.filter(F.col("last_id") >= first_id)
    if last_id is not None:
        rows, files = rows.filter(F.col("doc_id") <= last_id), files.filter(F.col("first_id") <= last_id)
    rows = rows.select("doc_id", "part", "local_start", "n_tokens", *columns)
    return rows.join(files.select("part", "offset"), "part") \
        .select("doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", *columns)


def metadata(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, meta): the ids are not read."""
    return documents(spark, path, first_id, last_id, ("meta",))


def tokens_between(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(doc_id, start, ids): the ids at positions ``start`` to ``stop`` - 1 of all documents in a row.

    Only the files that hold such positions are read, and of them the pages whose
    ``local_start`` can.
    """
    hit = [(r["part"], r["offset"]) for r in index(spark, path).filter(
        (F.col("offset") < stop) & (F.col("offset") + F.col("n_tokens") > start)).select("part", "offset").collect()]
    rows = spark.read.parquet(f"{path}/tokens")
    inside = F.lit(False)
    for part, offset in sorted(hit):
        inside = inside | ((F.col("part") == part) & (F.col("local_start") < stop - offset)
                           & (F.col("local_start") + F.col("n_tokens") > start - offset))
    offsets = spark.createDataFrame(hit, "part int, offset long")
    begin = F.greatest(F.lit(start) - F.col("begin"), F.lit(0))
    end = F.least(F.lit(stop) - F.col("begin"), F.col("n_tokens"))
    return rows.filter(inside).join(offsets, "part").withColumn("begin", F.col("offset") + F.col("local_start")) \
        .select("doc_id", (F.col("begin") + begin).alias("start"),
                F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids"))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def digest(batches):
        for b in batches:
            ids = b.column(3)
            offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
            crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            n = pa.array(np.diff(offsets).astype(np.int64))  # counted, not taken from the column
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n, pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return documents(spark, path).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
