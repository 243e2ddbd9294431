"""Shared helpers: reading tables, Arrow text buffers, 64-bit hashing, scratch tables."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clickpulse.session import scratch_dir

# Rows per Arrow batch handed to Python: a batch of very long texts stays small
# enough for two workers in an executor of 3 GB.
ROWS_PER_BATCH = 512

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; batches handed to Python workers are kept short."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back.

    This cuts the lineage: a lost executor costs no recomputation of ``df``.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary Arrow column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) else b"")
    n, at = len(col), col.offset
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], kind)[at:at + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def runs(offsets: np.ndarray, size: int):
    """(first, last) row ranges holding at most ``size`` bytes, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64 (n + 1 values)."""
    out = np.full(n + 1, base % (1 << 64), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Rolling polynomial hashes modulo 2^64 of spans shorter than 1,024 values (op4's contexts).

    Some different spans of 1,024 values or more are equal in every base: PrimeRolling tells them apart.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n, 2 * len(self.up))
            self.up = powers(self.BASE, n)
            self.down = powers(pow(self.BASE, -1, 1 << 64), n)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums from which :meth:`spans` takes its hashes."""
        n = len(values)
        self._grow(n)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each span [start, end); equal spans hash equally wherever they stand."""
        return mix((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


_P = np.uint64((1 << 61) - 1)  # a prime, of which remainders need shifts only
_LOW, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_S1, _S30, _S31, _S61 = (np.uint64(k) for k in (1, 30, 31, 61))


def remainder(x: np.ndarray) -> np.ndarray:
    """64-bit values modulo 2^61 - 1."""
    x = (x & _P) + (x >> _S61)
    return np.where(x >= _P, x - _P, x)


def multiplied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of values below it, from halves of 30 and 31 bits."""
    ah, al, bh, bl = a >> _S31, a & _LOW, b >> _S31, b & _LOW
    middle = ah * bl + al * bh
    return remainder((ah * bh << _S1) + (middle >> _S30) + ((middle & _LOW30) << _S31) + al * bl)


def prime_powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^61 - 1 (n + 1 values)."""
    out, have = np.ones(n + 1, np.uint64), 1
    while have <= n:
        more = min(have, n + 1 - have)
        out[have:have + more] = multiplied(out[:more], np.uint64(pow(base, have, int(_P))))
        have += more
    return out


class PrimeRolling:
    """Rolling polynomial hashes modulo the prime 2^61 - 1 of any spans of a sequence.

    Two different spans of n values have equal hashes in at most n of the 2^61 bases.
    """

    BASE = 0x9E3779B97F4A7C15 % ((1 << 61) - 1)
    BLOCK = 1 << 16  # values summed at a time, so that intermediate arrays stay small

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n, 2 * len(self.up))
            self.up = prime_powers(self.BASE, n)
            self.down = prime_powers(pow(self.BASE, -1, int(_P)), n)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums from which :meth:`spans` takes its hashes."""
        n = len(values)
        self._grow(n)
        out = np.zeros(n + 1, np.uint64)
        for i in range(0, n, self.BLOCK):
            j = min(n, i + self.BLOCK)
            part = multiplied(remainder(values[i:j]), self.up[i:j])
            high, low = np.cumsum(part >> _S31), np.cumsum(part & _LOW)  # at most 2^47 each
            out[i + 1:j + 1] = remainder((high >> _S30) + ((high & _LOW30) << _S31) + low + out[i])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each span [start, end); equal spans hash equally wherever they stand."""
        sums = remainder(prefix[end] + (_P - prefix[start]))
        return mix(multiplied(sums, self.down[start]) + (end - start).astype(np.uint64))


# One random-looking 64-bit value per byte, never zero.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
