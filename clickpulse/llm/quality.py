"""Quality rules: repetition coverage (op1).

Rolling hashes of several n-gram lengths, computed in numpy over the word
sequence of each text, mark every n-gram that repeats an earlier one of the same
text; the measures are the shares of the words' characters that lie inside such
n-grams, and inside lines equal to an earlier line. One scan, no shuffle.

A word is a maximal run of characters other than space and ``\\x09-\\x0D``.
Defined results: a null or empty text has no word and fails the base rule;
repeated rows are judged one by one; other columns are passed through by
:func:`keep_good` and ignored by :func:`quality_rules`; an empty table gives an
empty result. A text is held whole: memory is about 60 bytes per byte of the
longest text in a batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import BYTE_VALUES, PrimeRolling, mix, runs, text_bytes

# Largest allowed share (per cent) of the words' characters inside repeats
# of n-grams, by n-gram length, and of lines (first occurrences not counted). Fixed values, as
# published for web text filters (5- to 10-grams: 15 to 10 %, lines: 20 %).
NGRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_LIMIT = 20
MIN_WORDS = 10
BASE_LENGTH = 5
BASE_LIMIT = 20

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, dup_line_chars long, "
          + ", ".join(f"dup_{n}gram_chars long" for n in NGRAM_LIMITS))

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(every key that occurs more than once, the same without each first occurrence)."""
    every, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys) < 2:
        return every, later
    order = np.argsort(keys)
    begins = np.flatnonzero(np.r_[True, keys[order[1:]] != keys[order[:-1]]])
    sizes = np.diff(begins, append=len(keys))
    every[order] = np.repeat(sizes > 1, sizes)
    later[:] = every
    later[np.minimum.reduceat(order, begins)] = False
    return every, later


def _covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Which of ``n`` words lie inside a k-gram that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    edge[starts] += 1
    edge[starts + k] -= 1
    return np.cumsum(edge[:-1]) > 0


def measure(offsets: np.ndarray, data: np.ndarray, rolling: PrimeRolling) -> dict[str, np.ndarray]:
    """Measures of the texts that lie one after another in ``data``."""
    n_docs, n = len(offsets) - 1, len(data)
    per_doc = lambda docs, w=None: np.bincount(docs, w, n_docs).astype(np.int64)
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1

    sep = _SEPARATOR[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = sep[:-1], sep[1:]
    before[first], after[last] = True, True
    start = np.flatnonzero(~sep & before)
    end = np.flatnonzero(~sep & after) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    points = np.zeros(n + 1, np.int64)  # code points of words up to a byte
    np.cumsum(((data & 0xC0) != 0x80) & ~sep, out=points[1:])
    chars = points[end] - points[start]
    prefix = rolling.prefix(BYTE_VALUES[data])

    out = {"n_words": per_doc(doc), "word_chars": per_doc(doc, chars),
           "n_symbols": per_doc(np.searchsorted(offsets, np.flatnonzero(_SYMBOL[data]), "right") - 1)}

    # lines with a word
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([first, breaks[breaks + 1 < n] + 1]))
    line_start = line_start[np.r_[True, line_start[1:] != line_start[:-1]]] if len(line_start) else line_start
    line_doc = np.searchsorted(offsets, line_start, "right") - 1
    line_end = np.append(line_start[1:], n)
    line_end = line_end - ((line_end > line_start) & (data[line_end - 1] == 10) if n else 0)
    line_chars = points[line_end] - points[line_start]
    has = line_chars > 0
    line_start, line_end, line_doc, line_chars = (a[has] for a in (line_start, line_end, line_doc, line_chars))
    _, later = _twice(rolling.spans(prefix, line_start, line_end) ^ mix(line_doc.astype(np.uint64)))
    out["n_dup_lines"] = per_doc(line_doc[later])
    out["dup_line_chars"] = per_doc(line_doc[later], line_chars[later])

    # n-grams of words
    words = rolling.spans(prefix, start, end)
    seq = rolling.prefix(words)
    salt = mix(doc.astype(np.uint64))
    for k in NGRAM_LIMITS:
        m = max(0, len(words) - k + 1)
        at = np.flatnonzero(doc[:m] == doc[len(doc) - m:])
        every, later = _twice(rolling.spans(seq, at, at + k) ^ salt[at])
        covered = _covered(len(words), at[later], k)
        out[f"dup_{k}gram_chars"] = per_doc(doc[covered], chars[covered])
        if k == BASE_LENGTH:
            out["n_repeat_words"] = per_doc(doc[_covered(len(words), at[every], k)])

    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > BASE_LIMIT * out["n_words"])
    bad = 100 * out["dup_line_chars"] > LINE_LIMIT * out["word_chars"]
    for k, limit in NGRAM_LIMITS.items():
        bad |= 100 * out[f"dup_{k}gram_chars"] > limit * out["word_chars"]
    out["kept"] = ~out["base_failed"] & ~bad
    return out


def _measure_batches(batches, id_at: int, text_at: int, names: list[str], only_kept: bool, piece: int = 1 << 20):
    rolling = PrimeRolling()
    for batch in batches:
        offsets, data = text_bytes(batch.column(text_at))
        parts = [measure(offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]], rolling)
                 for i, j in runs(offsets, piece)]
        if not parts:
            continue
        if only_kept:
            yield batch.filter(pa.array(np.concatenate([p["kept"] for p in parts])))
            continue
        cols = [pa.array(np.concatenate([p[c] for p in parts])) for c in names]
        yield pa.RecordBatch.from_arrays([batch.column(id_at), *cols], ["doc_id", *names])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the measures, the base rule's verdict and ``kept``."""
    names = [c.split()[0] for c in SCHEMA.split(", ")][1:]
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(lambda it: _measure_batches(it, 0, 1, names, False), SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes the rules."""
    at = docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: _measure_batches(it, 0, at, [], True), docs.schema)
