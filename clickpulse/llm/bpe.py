"""Byte-level BPE encoding and decoding by a global distinct-word shuffle (op6).

1. Explode: each task splits its documents into pre-tokens: character classes in
   numpy say where one begins. A block of documents (a run of rows of one input
   partition, about ``CHUNK_BYTES`` of text) is dictionary-encoded: it has its
   distinct pre-tokens once and, in order, the number of the pre-token at every
   position. It is split and put together a run of about ``RUN_BYTES`` of text at a
   time, a row each. A block is split twice, for the pre-tokens and for the positions
   (a checksum makes sure that both were the same rows), or once and written.
2. Global distinct: the blocks' pre-tokens are shuffled by hash, so each distinct
   pre-token of the corpus is encoded once, in one bucket. A pre-token comes once
   per block however often the block repeats it, so frequent ones are no hot keys.
3. Join back: the ids return to their blocks; each block reassembles the id
   sequences of its documents by position, run by run.
4. Decoding joins the token-byte table (bounded by the vocabulary) to the ids of
   the distinct pre-tokens and reassembles the bytes the same way.

Defined results: a null text is empty; an empty text has no ids; rows with equal
or null ids are encoded one by one; extra columns are ignored; an empty table
gives an empty result. A run holds at least one whole document, so memory is
bounded by a run or by the longest text (about 40 bytes per byte of it), besides four
bytes per position of a block and its distinct pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections.abc import Callable
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import runs, text_bytes, written

CHUNK_BYTES = 8 << 20    # text in one block
RUN_BYTES = 1 << 20      # text split, and put together, at a time
SLICE = 1 << 16          # pre-tokens that are Python objects at a time
BUCKET_BYTES = 32 << 20  # text whose pre-tokens go to one bucket

# Letters, numbers and white space below U+0100, by Unicode category.
LATIN_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_SPACES = "\t\n\x0b\x0c\r \x85\xa0"


class Scheme:
    """How to split a text into pre-tokens and how to encode one pre-token."""

    def splitter(self) -> Callable[[bytes], list]:
        """A function from UTF-8 text to its pre-tokens (all str or all bytes)."""
        raise NotImplementedError

    def encoder(self) -> Callable[[list[bytes]], list[list[int]]]:
        """A function from distinct pre-tokens (UTF-8) to their ids."""
        raise NotImplementedError


class ByteBpe(Scheme):
    """Pre-tokens of a pattern, merged by a rank file as the tiktoken library does."""

    def __init__(self, rank_file: str, pattern: str = public_tokenizers.PATTERN) -> None:
        self.rank_file, self.pattern = rank_file, pattern

    def ranks(self) -> dict[bytes, int]:
        with open(self.rank_file, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}

    def splitter(self):
        import regex
        general = regex.compile(self.pattern)
        if self.pattern != public_tokenizers.PATTERN:
            return lambda text: general.findall(text.decode())
        # the same pattern spelled out for texts below U+0100, for the faster engine
        a, n, s = LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACES
        latin = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{a}]+| ?[{n}]+| ?[^{s}{a}{n}]+|[{s}]+(?![^{s}])|[{s}]+")

        def split(raw: bytes) -> list[str]:
            text = raw.decode()
            return (latin if _below_256(raw) else general).findall(text)

        return split

    def cutter(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """A function from texts (offsets, UTF-8 bytes) to the places where their pre-tokens begin."""
        if self.pattern == public_tokenizers.PATTERN:
            return Cutter().starts
        split = self.splitter()

        def starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
            # findall leaves out what the pattern does not match, as the library does: such patterns are refused
            sizes = [len(w.encode()) for i, j in zip(offsets[:-1], offsets[1:]) for w in split(data[i:j].tobytes())]
            ends = np.cumsum(sizes, dtype=np.int64)
            if (int(ends[-1]) if len(ends) else 0) != len(data):
                raise ValueError("the pattern leaves out characters")
            return offsets[0] + ends - np.array(sizes, np.int64)

        return starts

    def encoder(self):
        import tiktoken
        coder = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks(), special_tokens={})
        return lambda words: [coder.encode_ordinary(w.decode()) for w in words]


LETTER, NUMBER, SPACE, OTHER = range(4)


class Cutter:
    """Finds where the pre-tokens of ``public_tokenizers.PATTERN`` begin, from the classes of the characters.

    A pre-token is a run of one class. Of white space before other characters, the last one stands
    alone, or belongs to what follows if it is a space. An apostrophe that begins a pre-token
    and is followed by one of the pattern's endings takes these letters only.
    """

    def __init__(self) -> None:
        self.classes = np.zeros(0, np.uint8)

    def _classes(self, top: int) -> np.ndarray:
        """Class of every code point up to ``top`` at least."""
        if len(self.classes) <= top:
            import regex
            size = next(n for n in (0x100, 0x10000, 0x110000) if n > top)
            points = np.arange(size, dtype="<u4")
            points[0xD800:0xE000] = 0  # surrogates occur in no text
            every = points.tobytes().decode("utf-32-le")
            self.classes = np.full(size, OTHER, np.uint8)
            for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
                for m in regex.finditer(pattern, every):
                    self.classes[m.start():m.end()] = kind
        return self.classes

    def starts(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Byte places where pre-tokens begin; ``data`` holds the texts from ``offsets[0]`` on."""
        if not len(data):
            return np.zeros(0, np.int64)
        points, at = data, None
        if int(data.max()) >= 0x80:
            points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            at = np.cumsum(width, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
            at -= width
        n, kind = len(points), self._classes(int(points.max()))[points]
        first = offsets[:-1][offsets[:-1] < offsets[1:]] - offsets[0]
        first = first if at is None else np.searchsorted(at, first.astype(at.dtype))
        last = np.zeros(n, bool)  # last characters of texts
        last[np.r_[first[1:], n] - 1] = True
        begin = np.ones(n, bool)
        np.not_equal(kind[1:], kind[:-1], out=begin[1:])
        begin[first] = True
        # white space before something else
        ends = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~last[:-1])
        begin[ends] = True
        begin[ends[points[ends] == 0x20] + 1] = False
        # apostrophes with an ending: 's 't 'm 'd, 're 've 'll
        quote = np.flatnonzero((points[:-1] == 0x27) & begin[:-1] & (kind[1:] == LETTER) & ~last[:-1])
        one = points[quote + 1]
        two = np.where(last[quote + 1], 0, points[np.minimum(quote + 2, n - 1)])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (two == ord("l")) & (one == ord("l"))
        begin[quote[short | long] + 1] = False
        after = np.r_[quote[short] + 2, quote[long] + 3]
        begin[after[after < n]] = True
        found = np.flatnonzero(begin)
        return offsets[0] + (found if at is None else at[found])


def _below_256(raw: bytes) -> bool:
    """Whether a UTF-8 text has no code point above U+00FF (no lead byte above 0xC3)."""
    return not len(raw) or raw.isascii() or int(np.frombuffer(raw, np.uint8).max()) <= 0xC3


def _pack(*arrays: bytes | np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(3).compress(b"".join(arrays) if len(arrays) > 1 else arrays[0])


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _binary(offsets: np.ndarray, data) -> pa.LargeBinaryArray:
    """Arrow array of the byte strings between ``offsets``, which begin at 0."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1,
                                            [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def _parts(array: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an array of byte strings without nulls."""
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _release() -> None:
    """Gives freed Arrow memory back to the system: a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()


def _slices(words: pa.LargeBinaryArray):
    """The byte strings, some at a time."""
    for i in range(0, len(words), SLICE):
        yield words.slice(i, SLICE).to_pylist()


def _blocks(batches, cut, chunk_bytes: int, codes: bool):
    """(block, checksum, runs, distinct pre-tokens of each run) for runs of rows of one input partition.

    A run, with ``codes``: document ids, pre-tokens per document, and where every position's pre-token
    stands in the distinct pre-tokens of all the block's runs, one after another.
    """
    part, seq = TaskContext.get().partitionId(), 0
    some, words, held, known, check = [], [], 0, 0, 0
    for batch in batches:
        offsets, data = text_bytes(batch.column(1))
        for i, j in runs(offsets, min(RUN_BYTES, chunk_bytes)):
            size = int(offsets[j] - offsets[i])
            if words and held + size > chunk_bytes:
                yield (part << 32) | seq, check, some, words
                some, words, held, known, check, seq = [], [], 0, 0, 0, seq + 1
            raw, here = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            begin = cut(here, raw)
            coded = _binary(np.r_[begin, size], raw).dictionary_encode()
            if codes:
                at = coded.indices.to_numpy().astype(np.uint32)
                at += np.uint32(known)
                some.append((batch.column(0).slice(i, j - i).to_pylist(), np.diff(np.searchsorted(begin, here)), at))
            words.append(coded.dictionary)
            known += len(coded.dictionary)
            held += size + j - i
            check = zlib.crc32(raw, zlib.crc32(here, check))
    if words:
        yield (part << 32) | seq, check, some, words


def _numbered(words: list[pa.LargeBinaryArray], buckets: int):
    """(distinct pre-tokens by bucket, their buckets, number of each of ``words``)."""
    coded = pa.concat_arrays(words).dictionary_encode()
    distinct = coded.dictionary
    home = np.fromiter((zlib.crc32(w) for some in _slices(distinct) for w in some), np.int64, len(distinct)) % buckets
    order = np.argsort(home, kind="stable")
    number = np.empty(len(order), np.uint32)
    number[order] = np.arange(len(order), dtype=np.uint32)
    return distinct.take(pa.array(order)), home[order], number[coded.indices.to_numpy()]


ROWS = ("chunk long, check long, bucket int, words binary, doc_ids array<long>, counts array<long>, codes binary")


def _send(batches, cut, buckets: int, chunk_bytes: int, words: bool, codes: bool):
    """Rows of each block: its distinct pre-tokens by bucket (``words``), and each run's documents with
    the numbers of their pre-tokens in order (``codes``)."""
    kinds = pa.schema([("chunk", pa.int64()), ("check", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()),
                       ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary())])

    def sent(found) -> pa.RecordBatch:
        block, check, some, known = found
        distinct, home, number = _numbered(known, buckets)
        rows = []
        for ids, counts, at in some:
            planes = np.ascontiguousarray(number[at].view(np.uint8).reshape(-1, 4).T).ravel()
            rows.append({"chunk": block, "check": check, "doc_ids": ids, "counts": counts, "codes": _pack(planes)})
        if words:
            offsets, data = _parts(distinct)
            edges = np.searchsorted(home, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                i, j = edges[b], edges[b + 1]
                sizes = np.r_[j - i, np.diff(offsets[i:j + 1])].astype(np.uint32)
                rows.append({"chunk": block, "check": check, "bucket": b,
                             "words": _pack(sizes.tobytes(), data[offsets[i]:offsets[j]].tobytes())})
        _release()
        return pa.RecordBatch.from_pylist(rows, kinds)

    yield from map(sent, _blocks(batches, cut, chunk_bytes, codes))  # no block is held while the next one is read


def _encode_bucket(t: pa.Table, encode) -> pa.Table:
    """The ids of every block's pre-tokens of one bucket; each distinct pre-token is encoded once."""
    counts, sizes, texts = [], [], []
    for blob in t["words"].to_pylist():
        raw = _unpack(blob)
        n = int(np.frombuffer(raw, np.uint32, 1)[0])
        counts.append(n)
        sizes.append(np.frombuffer(raw, np.uint32, n, 4))
        texts.append(np.frombuffer(raw, np.uint8, offset=4 * (n + 1)))
    ends = np.zeros(sum(counts) + 1, np.int64)
    np.cumsum(np.concatenate(sizes), out=ends[1:])
    sizes, texts = None, np.concatenate(texts)
    coded = _binary(ends, texts).dictionary_encode()
    ends = texts = raw = None
    n_ids, flat = [], []
    for some in _slices(coded.dictionary):
        found = encode(some)
        n_ids.append(np.fromiter(map(len, found), np.int64, len(found)))
        flat.append(np.fromiter(chain.from_iterable(found), np.uint32, int(n_ids[-1].sum())))
    n_ids, flat = np.concatenate(n_ids), np.concatenate(flat)
    places, blobs, i = coded.indices.to_numpy(), [], 0
    for n in counts:
        at = places[i:i + n]
        blobs.append(_pack(np.uint32(n).tobytes(), n_ids[at].astype(np.uint32).tobytes(), _spread(flat, n_ids, at).tobytes()))
        i += n
    coded = places = None
    _release()
    return pa.table({"chunk": t["chunk"], "check": t["check"], "bucket": t["bucket"],
                     "ids": pa.array(blobs, pa.binary())})


def _spread(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pieces number ``at`` of ``flat``, which holds pieces of ``sizes``, one after another."""
    each = sizes[at]
    upto = np.cumsum(each)
    shift = np.repeat((np.cumsum(sizes) - sizes)[at] - (upto - each), each)
    return flat[np.arange(len(shift)) + shift]


class Block:
    """One block's documents with their ids: what ``assemble`` functions receive."""

    def __init__(self, docs: pa.Table, ids: pa.Table) -> None:
        self.docs = docs
        sizes, flat = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for blob in ids.sort_by("bucket")["ids"].to_pylist():
            raw = np.frombuffer(_unpack(blob), np.uint32)
            sizes.append(raw[1:1 + raw[0]])
            flat.append(raw[1 + raw[0]:])
        self.sizes, self.flat = np.concatenate(sizes).astype(np.int64), np.concatenate(flat)

    def runs(self):
        """Run by run: (document ids, positions before each document and of all, numbers of their pre-tokens)."""
        for k in range(self.docs.num_rows):
            counts, blob = self.docs["counts"][k].values.to_numpy(), self.docs["codes"][k].as_py()
            planes = np.frombuffer(_unpack(blob), np.uint8).reshape(4, -1)
            codes = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
            yield self.docs["doc_ids"][k].values, np.r_[0, np.cumsum(counts)], codes

    def token_ids(self, codes: np.ndarray) -> np.ndarray:
        """A run's ids one after another."""
        return _spread(self.flat, self.sizes, codes)

    def token_offsets(self, upto: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Tokens before each document of a run, and of all."""
        return np.r_[0, np.cumsum(self.sizes[codes])][upto]

    def spelled(self, table: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Each pre-token's entries of ``table``, an entry per id, one after another."""
        entries, data = _parts(table.take(pa.array(self.flat)))
        return _binary(entries[np.r_[0, np.cumsum(self.sizes)]], data)


def _joined(words: pa.LargeBinaryArray, upto: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the documents of a run, their pre-tokens spelled by ``words``."""
    offsets, data = _parts(words.take(pa.array(codes)))
    return offsets[upto], data


def encode_documents(docs: DataFrame, scheme: ByteBpe, assemble: Callable[[Block], pa.Table], schema: str,
                     id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
                     bucket_bytes: int = BUCKET_BYTES, keep_blocks: bool = False) -> DataFrame:
    """``assemble`` applied to every block of documents once its pre-tokens are encoded.

    ``keep_blocks`` writes the blocks to the shared scratch folder instead of
    splitting the texts twice: less CPU time, about as much disk again.
    """
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))

    def blocks(words: bool, codes: bool) -> DataFrame:
        def send(batches):
            return _send(batches, scheme.cutter(), buckets, chunk_bytes, words, codes)

        return picked.mapInArrow(send, ROWS)

    held: list = []  # the encoder of a task

    def encode_bucket(t: pa.Table) -> pa.Table:
        if not held:
            held.append(scheme.encoder())
        return _encode_bucket(t, held[0])

    def assembled(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or len({*left["check"].to_pylist(), *right["check"].to_pylist()}) != 1:
            raise RuntimeError("a block was read differently for encoding and for assembling")
        _release()
        return assemble(Block(left, right))

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if keep_blocks:
        both = written(blocks(True, True), "blocks")
        with_words, with_codes = both.filter("bucket is not null"), both.filter("bucket is null")
    else:
        with_words, with_codes = blocks(True, False), blocks(False, True)
    ids = with_words.select("chunk", "check", "bucket", "words").groupBy("bucket") \
        .applyInArrow(encode_bucket, "chunk long, check long, bucket int, ids binary")
    return with_codes.select("chunk", "check", "doc_ids", "counts", "codes").groupBy("chunk") \
        .cogroup(ids.groupBy("chunk")).applyInArrow(assembled, schema)


def _token_bytes(scheme: ByteBpe) -> pa.LargeBinaryArray:
    """The token-byte table: bytes of each id; ids that the file lacks are empty."""
    ranks = {i: b for b, i in scheme.ranks().items()}
    return pa.array([ranks.get(i, b"") for i in range(max(ranks, default=-1) + 1)], pa.large_binary())


def byte_bpe_digest(docs: DataFrame, scheme: ByteBpe, **options) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document's ids and their decoding."""
    held: list = []  # tables of a task

    def assemble(block: Block) -> pa.Table:
        if not held:
            held.append(_token_bytes(scheme))
            held.append(pa.array([b"%d," % i for i in range(len(held[0]))], pa.large_binary()))
        decoded, texts = map(block.spelled, held)
        sha = lambda offsets, data, less: [hashlib.sha256(data[i:max(i, j - less)]).hexdigest()
                                           for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        return pa.concat_tables(
            pa.table({"doc_id": ids, "n_tokens": pa.array(np.diff(block.token_offsets(upto, codes)), pa.int64()),
                      "ids_sha256": pa.array(sha(*_joined(texts, upto, codes), 1), pa.string()),
                      "decoded_sha256": pa.array(sha(*_joined(decoded, upto, codes), 0), pa.string())})
            for ids, upto, codes in block.runs())

    return encode_documents(docs, scheme, assemble,
                            "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", **options)


def byte_bpe_ids(docs: DataFrame, scheme: ByteBpe, **options) -> DataFrame:
    """(doc_id, ids, decoded): the ids of every document and the text they decode to."""

    def assemble(block: Block) -> pa.Table:
        words, parts = block.spelled(_token_bytes(scheme)), []
        for doc_ids, upto, codes in block.runs():
            offsets, ids = block.token_offsets(upto, codes), block.token_ids(codes)
            ends, data = _joined(words, upto, codes)
            parts.append(pa.table({
                "doc_id": doc_ids, "ids": pa.array([ids[i:j].tolist() for i, j in zip(offsets[:-1], offsets[1:])], pa.list_(pa.int32())),
                "decoded": pa.array([data[i:j].tobytes().decode() for i, j in zip(ends[:-1], ends[1:])], pa.string())}))
        return pa.concat_tables(parts)

    return encode_documents(docs, scheme, assemble, "doc_id long, ids array<int>, decoded string", **options)
