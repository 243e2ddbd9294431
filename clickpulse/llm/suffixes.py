"""Suffix arrays by the difference-cover algorithm, vectorised in numpy.

Sort the triples at positions 1 and 2 modulo 3, name them, recurse on the names,
sort the remaining suffixes by (symbol, rank of the next suffix) and merge.
"""

from __future__ import annotations

import numpy as np

_BITS = 21


def _triples(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first-of-its-value flags in that order) of the triples at ``at``."""
    a, b, c = s[at], s[at + 1], s[at + 2]
    if int(s.max()) < 1 << _BITS:
        key = (a << (2 * _BITS)) | (b << _BITS) | c
        order = np.argsort(key, kind="stable")
        key = key[order]
        return order, np.r_[True, key[1:] != key[:-1]]
    order = np.lexsort((c, b, a))
    a, b, c = a[order], b[order], c[order]
    return order, np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``s`` (positive integers) in order."""
    n = len(s)
    if n < 24:
        values = s.tolist()
        return np.array(sorted(range(n), key=lambda i: values[i:]), np.int64)
    padded = np.concatenate([s.astype(np.int64), np.zeros(4, np.int64)])
    # sampled positions; one past the end closes the first class when n = 1 modulo 3
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    at = np.concatenate([one, two])
    order, fresh = _triples(padded, at)
    names = np.empty(len(at), np.int64)
    names[order] = np.cumsum(fresh)
    sampled = at[order] if fresh.all() else at[suffix_array(names)]
    sampled = sampled[sampled < n]

    rank = np.zeros(n + 4, np.int64)
    rank[sampled] = np.arange(1, len(sampled) + 1)
    rest = np.arange(0, n, 3)
    key = (padded[rest] << 32) | rank[rest + 1]
    by = np.argsort(key, kind="stable")
    rest, key = rest[by], key[by]

    # merge: how many sampled suffixes of either class come before each remaining one
    first = sampled[sampled % 3 == 1]
    second = sampled[sampled % 3 == 2]
    ahead = np.searchsorted((padded[first] << 32) | rank[first + 1], key)
    top = int(padded.max()) + 1
    pair0 = padded[rest] * top + padded[rest + 1]
    pair2 = padded[second] * top + padded[second + 1]
    _, number = np.unique(np.concatenate([pair0, pair2]), return_inverse=True)
    ahead += np.searchsorted((number[len(rest):] << 32) | rank[second + 2], (number[:len(rest)] << 32) | rank[rest + 2])
    out = np.empty(n, np.int64)
    place = ahead + np.arange(len(rest))
    taken = np.zeros(n, bool)
    taken[place] = True
    out[place] = rest
    out[~taken] = sampled
    return out


def repeated_starts(texts: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """For each text, which of its first ``starts[i]`` positions begin a ``length``-byte string
    that also begins at another such position of any of the texts."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(t + b"\0" for t in texts) + b"\0" * length, np.uint8)
    m, n = len(texts), int(sizes.sum())
    symbols = data[:n].astype(np.int64) + m + 1
    symbols[begin + sizes - 1] = np.arange(1, m + 1)  # a different end mark for each text
    counts = np.array(starts, np.int64)
    wanted = np.zeros(n, bool)
    at = np.repeat(begin, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    wanted[at] = True
    array = suffix_array(symbols)
    array = array[wanted[array]]
    # adjacent prefixes, eight bytes at a time
    words = length // 8
    view = np.ndarray((n, words), np.uint64, data, 0, (1, 8))
    tail = np.ndarray((n,), np.uint64, data, length - 8, (1,))
    same = np.zeros(max(0, len(array) - 1), bool)
    for i in range(0, len(same), 1 << 14):
        a, b = array[i:i + (1 << 14)], array[i + 1:i + 1 + (1 << 14)]
        k = min(len(a), len(b))
        a, b = a[:k], b[:k]
        same[i:i + k] = (view[a] == view[b]).all(axis=1) & (tail[a] == tail[b])
    flags = np.zeros(n, bool)
    flags[array[1:][same]] = True
    flags[array[:-1][same]] = True
    return [flags[i:i + k] for i, k in zip(begin.tolist(), counts.tolist())]
