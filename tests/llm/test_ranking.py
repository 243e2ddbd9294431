from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from clickpulse.llm import ranking
from clickpulse.llm.common import PrimeRolling, table, text_bytes
from tests.conftest import SF_CHECK
from tests.llm import helpers as H


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    scored = ranking.score_documents(docs, ranking.train(docs, labels))
    rows = scored.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= ranking.DECISION)
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and sum(r.predicted == r.quality for r in held) / len(held) >= 0.9
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    pairs = [(a > b) + 0.5 * (a == b) for a in good for b in bad]
    assert sum(pairs) / len(pairs) >= 0.95


def test_repeat_features_match_brute_force():
    a, b = H.mirrored(10)
    texts = [f"{a} {b} c", f"{a} {b} {a}", "", " \n ", "a b c a b c a", H.words(1, 50) + " " + H.words(1, 20)]
    x = ranking.features(*text_bytes(pa.array(texts)), PrimeRolling())
    for row, text in zip(x, texts):
        w = H.WORD.findall(text)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        assert np.isclose(row[ranking.N_CLASSES + 4], (len(w) - len(set(w))) / max(1, len(w)))
        assert np.isclose(row[ranking.N_CLASSES + 5], (len(grams) - len(set(grams))) / max(1, len(w)))


def test_weights_reach_the_pairwise_optimum():
    rng = np.random.default_rng(3)
    y = (np.arange(800) % 2).astype(int)
    x = rng.normal(0, 1, (800, 4)) + 0.7 * y[:, None] * np.array([1, -1, 0.5, 0])
    model = ranking.BradleyTerry(x, y)
    z = (model.expand(x) - model.centre) / model.spread
    diff = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])  # every pair

    def loss(w):
        return np.logaddexp(0, -diff @ w).mean() + 0.5e-4 * w @ w

    best = np.zeros(z.shape[1])
    for _ in range(40):  # Newton steps on the loss of all pairs
        p = 1 / (1 + np.exp(diff @ best))
        grad = -(p[:, None] * diff).mean(axis=0) + 1e-4 * best
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + 1e-4 * np.eye(len(best))
        best -= np.linalg.solve(hess, grad)
    assert loss(best) <= loss(model.weights) <= loss(best) + 0.02
    a, b = z @ model.weights, z @ best
    assert np.corrcoef(np.argsort(np.argsort(a)), np.argsort(np.argsort(b)))[0, 1] >= 0.97
    assert (model.score(x) >= ranking.DECISION).sum() == (y == 1).sum()  # the quantile at the share of bad labels


def test_labels_held_out_are_never_read(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 "
                               "then 1 - quality else quality end as quality", "toxic")
    score = lambda m: sorted((r.doc_id, r.score) for r in ranking.score_documents(docs, m).collect())
    assert score(ranking.train(docs, labels)) == score(ranking.train(docs, turned))


def test_odd_rows(spark):
    docs, labels = H.odd_documents(spark), table(spark, SF_CHECK, "labels")
    model = ranking.train(table(spark, SF_CHECK, "documents"), labels)
    got = ranking.score_documents(docs, model).collect()
    assert len(got) == len(H.odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (5, 6)} == {next(r.score for r in got if r.doc_id == 6)}


def test_without_labels_and_empty_table(spark):
    docs, empty = H.odd_documents(spark), H.no_documents(spark)
    labels = spark.createDataFrame([(1, None, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert ranking.train(docs, labels) is None
    assert {r.score for r in ranking.score_documents(docs, None).collect()} == {0.5}
    assert ranking.score_documents(empty, None).count() == 0 and ranking.train(empty, labels) is None


def test_hot_ids_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(ranking, "TRAIN_ROWS", 60)
    docs = [(i, H.words(i, 12)) for i in range(200)] + [(i, H.words(i, 12)) for i in (3, 7, 11) for _ in range(150)]
    labels = [(i, i % 2) for i in range(200)] + [(i, i % 2) for i in (3, 7, 11) for _ in range(150)]
    seen = []
    monkeypatch.setattr(ranking, "BradleyTerry", lambda x, y: seen.append((x, y)))
    ranking.train(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                  spark.createDataFrame(labels, "doc_id long, quality int"))
    x, y = seen[0]
    assert len(x) == len(y) == 60 and len({tuple(r) for r in x.tolist()}) >= 50
