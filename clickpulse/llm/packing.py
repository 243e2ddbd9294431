"""Packing token sequences by minimum bin slack (op7).

Documents are tokenized where they are read, each word once per task (at most ``KNOWN``
are held), and end with an end id. Each is cut into whole windows and one remainder shorter than a
window. A whole window is a sequence by itself. The remainders are packed by
length: their histogram (at most window - 1 counts, gathered by an aggregate) is
filled into windows by a bitset subset-sum: bit s of a step's set says that
lengths up to that one can sum to s, each as often as its count allows, and
walking the sets back gives how many of each length the fullest window takes.
A pattern is used as often as its counts last, so there are at most a few
patterns per length, whatever the number of documents. The patterns go back to
the pieces by rank within their length.

When no multiset fills a window, the fullest one is taken unless an exact power
of two (which needs no padding) can be reached.

Ranks within a length are counted per group of pieces first, so a length that
holds a third of all pieces is numbered in parallel. Defined results: a null
text is empty, so the end id is its only one; rows with equal or null ids are
packed one by one; extra columns are ignored; an empty table gives an empty
result. Pieces are small: those of many tasks share a file, and the result has no
more partitions than its pieces need, however thinly the documents are dealt out.
A very long text is split whole by one worker: about 90 bytes per word.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickpulse.llm.bpe import LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACES, Scheme
from clickpulse.llm.common import text_bytes, written

WINDOW = 2048
END_ID = 1
GROUPS = 1024  # groups of pieces numbered on their own
KNOWN = 600_000  # words whose ids a task holds
PER_TASK = 50_000  # documents whose pieces share a file, pieces in one partition of the result


class WordBpe(Scheme):
    """Lower-casing word-end BPE of a ``tokenizers`` file.

    Its pre-tokens never hold white space, so a text is split at ASCII white space
    and its words are encoded one by one.
    """

    def __init__(self, file: str) -> None:
        self.file = file

    def splitter(self):
        return lambda raw: raw.lower().split()  # bytes: A-Z only, ASCII white space

    def encoder(self):
        from tokenizers import Tokenizer
        coder = Tokenizer.from_file(self.file)
        coder.encode_special_tokens = True
        a, n, s = LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACES
        latin = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{a}]+|[{n}]|[^{s}{a}{n}]+")
        # byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100
        plain = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
        alphabet = {b: chr(b) for b in plain}
        alphabet |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in alphabet)}
        known: dict[str, list[int]] = {}
        tokenize = coder.model.tokenize

        def plainly(mapped: str) -> list[int]:
            return [t.id for t in tokenize(mapped)]

        def core(piece: str) -> list[int]:
            ids = known.get(piece)
            if ids is None:
                if len(known) >= KNOWN:
                    known.clear()
                ids = known[piece] = plainly(piece.encode().decode("latin-1").translate(alphabet))
            return ids

        def encode(words: list[bytes]) -> list[list[int]]:
            out = []
            for raw in words:
                text = raw.decode()
                if raw.isalpha():  # ASCII letters, lower-cased by the splitter: one pre-token, bytes as they are
                    out.append(plainly(text.lower()))
                elif raw.isascii() or max(raw) <= 0xC3:  # stable under NFC; same pre-tokens as the file's pattern
                    out.append([i for piece in latin.findall(text.lower()) for i in core(piece)])
                else:
                    out.append(coder.encode(text, add_special_tokens=False).ids)
            return out

        return encode


class WordIds(dict):
    """Ids (four bytes each) of words; a word is encoded when it is first looked up."""

    def __init__(self, scheme: Scheme, most: int) -> None:
        super().__init__()
        self.encode, self.most = scheme.encoder(), most

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = array("I", self.encode([word])[0]).tobytes()
        return found


def _cut(batches, scheme: Scheme, window: int, end_id: int, known: int):
    """The pieces of each document."""
    split, find, end = scheme.splitter(), WordIds(scheme, known).__getitem__, array("I", [end_id]).tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    for batch in batches:
        offsets, data = text_bytes(batch.column(1))
        docs, starts, lengths, crcs, totals = [], [], [], [], []
        for k, (i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            raw = b"".join(map(find, split(data[i:j].tobytes()))) + end
            n = len(raw) // 4
            for at in range(0, n, window):
                docs.append(k)
                starts.append(at)
                lengths.append(min(window, n - at))
                crcs.append(zlib.crc32(raw[4 * at:4 * (at + window)]))
                totals.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(docs, pa.int64())),
             *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))], names=names)


def pieces(docs: DataFrame, scheme: Scheme, window: int = WINDOW, end_id: int = END_ID, known: int = KNOWN,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(piece, doc_id, start, length, ids_crc32, doc_tokens): whole windows and remainders.

    ``piece`` follows the order of the input; the pieces of ``PER_TASK`` documents share a file.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = picked.mapInArrow(lambda batches: _cut(batches, scheme, window, end_id, known),
                            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    files = min(1 + docs.count() // PER_TASK, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    numbered = cut.select(F.monotonically_increasing_id().alias("piece"), "*").repartition(files)
    return written(numbered, "pieces")


def fullest(counts: dict[int, int], window: int) -> dict[int, int]:
    """How many of each length fill ``window`` closest, by subset-sum over the counts."""
    mask = (1 << (window + 1)) - 1
    lengths = sorted(counts, reverse=True)
    sets, reach = [], 1
    for size in lengths:
        sets.append(reach)
        left, part = min(counts[size], window // size), 1
        while left:  # binary parts: any number up to the count
            take = min(part, left)
            reach |= (reach << (size * take)) & mask
            left -= take
            part *= 2
        if reach >> window & 1:
            break
    goal = reach.bit_length() - 1
    if goal < window:
        powers = [1 << e for e in range(window.bit_length()) if reach >> (1 << e) & 1]
        goal = max(powers, default=goal)
    out = {}
    for size, reach in zip(reversed(lengths[:len(sets)]), reversed(sets)):
        taken = 0
        while not reach >> goal & 1:
            goal -= size
            taken += 1
        if taken:
            out[size] = taken
    return out


def plan(histogram: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> number) and how many windows use each, covering the histogram."""
    left = {size: n for size, n in histogram.items() if n}
    out = []
    while left:
        pattern = fullest(left, window)
        times = min(left[size] // n for size, n in pattern.items())
        out.append((pattern, times))
        for size, n in pattern.items():
            left[size] -= n * times
            if not left[size]:
                del left[size]
    return out


def _slots(patterns: list, first: int) -> list[tuple]:
    """(length, from rank, upto rank, per window, first sequence, offset of the first) rows."""
    used: dict[int, int] = {}
    rows, sequence = [], first
    for pattern, times in patterns:
        offset = 0
        for size, n in pattern.items():
            at = used.get(size, 0)
            rows.append((size, at, at + n * times, n, sequence, offset))
            used[size] = at + n * times
            offset += size * n
        sequence += times
    return rows


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cut`` with each piece's sequence_id and offset in it."""
    spark = cut.sparkSession
    group = F.pmod(F.xxhash64("piece"), F.lit(GROUPS)).alias("group")
    grouped = cut.select("*", group)
    sizes = grouped.groupBy("length", "group").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("length", "group").orderBy("piece")
    ranked = grouped.withColumn("within", F.row_number().over(inside) - 1).join(bases, ["length", "group"]) \
        .withColumn("rank", F.col("base") + F.col("within"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    tasks = 1 + sum(histogram.values()) // PER_TASK
    whole = histogram.pop(window, 0)
    rows = _slots(plan(histogram, window), whole) + ([(window, 0, whole, 1, 0, 0)] if whole else [])
    slots = spark.createDataFrame(
        rows, "length long, lo long, hi long, per long, first long, at long")
    # bounded by the number of patterns: a few per length, lengths at most the window
    by_length = F.broadcast(slots.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi", "per", "first", "at"))).alias("ranges")))
    mine = F.element_at(F.filter("ranges", lambda x: (x["lo"] <= F.col("rank")) & (F.col("rank") < x["hi"])), 1)
    placed = ranked.join(by_length, "length").withColumn("slot", mine)
    nth = F.col("rank") - F.col("slot.lo")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("slot.first") + F.floor(nth / F.col("slot.per"))).cast("long").alias("sequence_id"),
        (F.col("slot.at") + F.pmod(nth, F.col("slot.per")) * F.col("length")).cast("long").alias("offset")).coalesce(tasks)


def pack_documents(docs: DataFrame, file: str | None = None, window: int = WINDOW, end_id: int = END_ID,
                   **options) -> DataFrame:
    """Every piece of every document with its place in the packed sequences."""
    scheme = WordBpe(file or public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces(docs, scheme, window, end_id, **options), window)
