from __future__ import annotations

import numpy as np
from hypothesis import given, settings, strategies as st

from clickpulse.llm import repeats, suffixes
from tests.llm import helpers as H

COLS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=150))
def test_suffix_array(values):
    want = sorted(range(len(values)), key=lambda i: values[i:])
    assert suffixes.suffix_array(np.array(values, np.int64)).tolist() == want


def test_suffix_array_of_large_symbols():
    s = np.random.default_rng(1).integers(1, 1 << 22, 500) // 100_000 * 100_000 + 1
    v = s.tolist()
    assert suffixes.suffix_array(s).tolist() == sorted(range(len(v)), key=lambda i: v[i:])


def check(spark, rows, length, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r[c] for c in COLS) for r in repeats.repeated_passages(docs, length, **options).collect()), key=H.key)
    assert got == sorted(H.without_repeats(rows, length), key=H.key)
    return got


def test_odd_texts(spark):
    rows = [(i, t if t is None else t[:20_000]) for i, t, *_ in H.odd_rows()]
    check(spark, rows, 200)


def test_long_text_in_slices(spark, monkeypatch):
    # slices of a long text give the same windows as the whole
    text = H.words(3, 3000) + H.words(4, 500) + H.words(3, 400)
    data = np.frombuffer(text.encode(), np.uint8)
    offsets = np.array([0, len(data)])
    seen = []
    for piece in (1 << 20, 2_000):
        monkeypatch.setattr(repeats, "PIECE", piece)
        import pyarrow as pa
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array([text])], ["k1", "k2", "text"])
        windows = set()
        for out in repeats._entries([batch], 200, 48):
            for r in out.to_pylist():
                for k in range(r["m"] * r["w"]):
                    assert (r["p0"] + k) not in windows
                    windows.add(r["p0"] + k)
        seen.append(windows)
    assert seen[0] == seen[1] == set(range(int(offsets[1]) - 199))


def test_shared_passages_and_heavy_anchors(spark):
    passage = H.words(50, 60)
    rows = [(i, H.words(100 + i, 20) + " " + passage[i % 7:] + " " + H.words(300 + i, 20)) for i in range(60)]
    rows += [(100 + i, H.words(100 + i, 20) + passage[:230 + i]) for i in range(20)]
    want = check(spark, rows, 64, gram=16)
    assert check(spark, rows, 64, gram=16, heavy=3, bucket=4_000) == want  # blocks of 8, then single windows


def test_without_repeats_keeps_rows(spark):
    docs = H.odd_documents(spark)
    out = repeats.without_repeats(docs)
    assert out.schema == docs.schema and out.count() == docs.count()
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].text == "" and by[5][0].text == "" and by[11][0].text == "word"
    assert by[17][0].text == H.words(6, 2100) and all(r._text == "clash" for r in out.collect())


def test_empty_table(spark):
    assert repeats.repeated_passages(H.no_documents(spark)).count() == 0
    assert repeats.without_repeats(H.no_documents(spark)).count() == 0
