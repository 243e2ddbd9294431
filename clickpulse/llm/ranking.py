"""Quality classifier by Bradley-Terry pairwise ranking (op5).

A document's score is linear in features of its whole text; the weights maximise
the Bradley-Terry likelihood of preference pairs (a labelled good document beats
a labelled bad one), that is logistic loss on feature differences. The cut is the
score quantile at the share of bad labels, and scores are shifted so that it
falls on the decision value. The model is fitted on a bounded sample of labelled
rows (``TRAIN_ROWS``) in numpy on the driver; scoring is one scan, no shuffle.

Features use nothing but the text. Defined results: a null text counts as empty,
and empty texts are scored like any other; rows without a label or an id are no
training rows; repeated rows count each time; without labels of both classes every
score is 0.5; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import BYTE_VALUES, PrimeRolling, mix, runs, text_bytes
from clickpulse.llm.quality import _SEPARATOR, _twice

TRAIN_ROWS = 20_000   # labelled documents the model may be fitted on
PAIRS = 120_000       # preference pairs drawn from them
DECISION = 0.3
KNOTS = (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)
SEED = 11

# Byte classes whose shares are features. The last takes all other bytes.
_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!",
           b"|", b"#*$%&", b"<>", b"\"'()[]{}", b":;=/_-@+?~^`\\", bytes(range(128, 256)))
_CLASS = np.full(256, len(_GROUPS), np.int64)
for _k, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _k
N_CLASSES = len(_GROUPS) + 1
EXTRA = 9
N_FEATURES = N_CLASSES + EXTRA


def features(offsets: np.ndarray, data: np.ndarray, rolling: PrimeRolling) -> np.ndarray:
    """One row of raw features per text."""
    n_docs, n = len(offsets) - 1, len(data)
    sizes = np.diff(offsets)
    doc_of = np.repeat(np.arange(n_docs), sizes)
    classes = np.bincount(doc_of * N_CLASSES + _CLASS[data], minlength=n_docs * N_CLASSES).reshape(n_docs, N_CLASSES)
    shares = classes / np.maximum(1, sizes)[:, None]

    sep = _SEPARATOR[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = sep[:-1], sep[1:]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = True
    after[offsets[1:][filled] - 1] = True
    start, end = np.flatnonzero(~sep & before), np.flatnonzero(~sep & after) + 1
    doc, length = doc_of[start], (end - start).astype(np.float64)
    per = lambda w=None: np.bincount(doc, w, n_docs)
    words = per()
    some = np.maximum(1, words)
    mean = per(length) / some
    spread = np.sqrt(np.maximum(0, per(length ** 2) / some - mean ** 2))
    hashes = rolling.spans(rolling.prefix(BYTE_VALUES[data]), start, end)
    salt = mix(doc.astype(np.uint64))
    _, again = _twice(hashes ^ salt)
    seq = rolling.prefix(hashes)
    m = max(0, len(hashes) - 2)
    at = np.flatnonzero(doc[:m] == doc[len(doc) - m:])
    _, thrice = _twice(rolling.spans(seq, at, at + 3) ^ salt[at])
    first = data[start] if n else np.zeros(0, np.uint8)
    final = data[end - 1] if n else np.zeros(0, np.uint8)
    capital = (first >= 65) & (first <= 90)
    odd = (final < 128) & (_CLASS[final] > 2)  # ends in a mark
    extra = np.stack([
        np.log1p(sizes), np.log1p(words), mean, spread, per(again.astype(float)) / some,
        np.bincount(doc[at], thrice.astype(float), n_docs) / some, per(capital.astype(float)) / some,
        per(odd.astype(float)) / some, per((length <= 3).astype(float)) / some], axis=1)
    return np.concatenate([shares, extra], axis=1)


def batch_features(batches, id_at: int = 0, text_at: int = 1, piece: int = 1 << 20):
    """(batch, features of its texts) pairs."""
    rolling = PrimeRolling()
    for batch in batches:
        offsets, data = text_bytes(batch.column(text_at))
        parts = [features(offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]], rolling)
                 for i, j in runs(offsets, piece)]
        yield batch, np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))


class BradleyTerry:
    """Additive scores: each raw feature enters with hinges at quantiles of the sample."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.knots = np.quantile(x, KNOTS, axis=0)
        self.width = np.maximum(x.std(axis=0), 1e-6)
        z = self.expand(x)
        self.centre, self.spread = z.mean(axis=0), np.maximum(z.std(axis=0), 1e-6)
        z = (z - self.centre) / self.spread
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        rng = np.random.default_rng(SEED)
        self.weights = np.zeros(z.shape[1])
        i, j = rng.choice(good, PAIRS), rng.choice(bad, PAIRS)
        m, v = np.zeros_like(self.weights), np.zeros_like(self.weights)
        size = 2_000
        for step in range(1, 8 * (PAIRS // size) + 1):
            at = slice((step * size) % PAIRS, (step * size) % PAIRS + size)
            diff = z[i[at]] - z[j[at]]
            p = 1 / (1 + np.exp(np.clip(diff @ self.weights, -50, 50)))
            grad = -(p[:, None] * diff).mean(axis=0) + 1e-4 * self.weights
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            self.weights -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        scores = np.sort(z @ self.weights)
        n_bad = min(len(scores) - 1, len(bad))
        self.cut = (scores[n_bad - 1] + scores[n_bad]) / 2  # quantile at the share of bad labels

    def expand(self, x: np.ndarray) -> np.ndarray:
        hinges = np.maximum(0, x[:, None, :] - self.knots[None]) / self.width
        return np.concatenate([x, np.minimum(hinges, 10).reshape(len(x), -1)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        s = ((self.expand(x) - self.centre) / self.spread) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(s + math.log(DECISION / (1 - DECISION)), -35, 35)))


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, mod 5; 0 is held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> BradleyTerry | None:
    """The model fitted on labelled documents that are not held out.

    At most TRAIN_ROWS different (id, label, text), by a hash of all three: repeated
    labels and rows of one id neither fill the sample nor go in or out together.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull() & (fold(id_col) != 0)) \
        .select(F.col(id_col).alias("doc_id"), F.col("quality").cast("int").alias("y")).distinct()
    # labels a little beyond the bound (16 bytes a row), then the bound itself
    share = min(1.0, (1.2 * TRAIN_ROWS + 4 * TRAIN_ROWS ** 0.5) / max(1, known.count()))
    some = known.filter(F.pmod(F.xxhash64("doc_id", "y"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    some = some.orderBy(F.xxhash64("doc_id", "y"), "doc_id", "y").limit(TRAIN_ROWS)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(some), "doc_id")
    picked = picked.withColumn("h", F.xxhash64("doc_id", "y", "text"))

    def run(batches):
        for batch, x in batch_features(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(x.tolist(), pa.list_(pa.float64()))],
                ["doc_id", "y", "h", "x"])

    got = picked.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y", "h") \
        .mapInArrow(run, "doc_id long, y int, h long, x array<double>") \
        .dropDuplicates(["doc_id", "y", "h"]).orderBy("h", "doc_id", "y").limit(TRAIN_ROWS).toPandas()
    if got.empty or got.y.nunique() < 2:
        return None
    got = got.sort_values(["doc_id", "y", "h"], kind="stable")
    return BradleyTerry(np.stack(got.x.to_numpy()), got.y.to_numpy())


def score_documents(docs: DataFrame, model: BradleyTerry | None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def run(batches):
        for batch, x in batch_features(batches):
            s = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= DECISION).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = picked.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")
