"""Fixtures of odd rows and brute-force versions of the operators."""

from __future__ import annotations

import collections
import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, bucket int, n long, x long"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéfgß") for _ in range(rng.randint(2, 9))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Null, empty, blank, very long, equal and near-equal texts; null and repeated ids."""
    a, b = words(1, 120), words(2, 300)
    long = words(3, 60_000)
    texts = [(1, a), (2, a), (3, b), (4, a + "\n" + b), (5, None), (6, ""), (7, " \t\n "), (8, long),
             (None, "x"), (None, b[:900]), (9, b), (9, b), (10, a.replace("a", "A")), (11, "word"),
             (12, "a\n" * 400), (13, "ab" * 700), (14, words(4, 50) + " " + a[100:700] + " " + words(5, 50)),
             (15, "日本語 のテキスト    İstanbul ſecret 😀 " * 3), (16, "\x1c\x85 'S it's 12½ <|endoftext|>"),
             (17, words(6, 2100)), (8, long)]
    return [(i, t, None if i == 3 else "en", None, None, "clash", 7, 8, 9) for i, t in texts]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def repeated_measures(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) straight from the contract."""
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def later_share(text: str | None, k: int) -> int:
    """Characters of words in k-grams that repeat an earlier one."""
    w = WORD.findall(text or "")
    seen, covered = set(), set()
    for i in range(len(w) - k + 1):
        gram = tuple(w[i:i + k])
        if gram in seen:
            covered.update(range(i, i + k))
        seen.add(gram)
    return sum(len(w[i]) for i in covered)


def without_repeats(rows: list[tuple], length: int) -> list[tuple]:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) by counting every window."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(b[i:i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for key, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((key, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def components(keys: list, linked) -> dict:
    """Smallest reachable key of every key, all pairs compared."""
    up = {k: k for k in keys}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def key(row) -> tuple:
    return tuple((x is not None, x) for x in row)


def mirrored(n: int) -> tuple[str, str]:
    """Two different words of 2^n letters with equal polynomial hashes modulo 2^64 from n = 10 on."""
    a = "".join("ab"[i.bit_count() & 1] for i in range(1 << n))
    return a, a.translate(str.maketrans("ab", "ba"))
