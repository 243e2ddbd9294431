from __future__ import annotations

import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from clickpulse.llm import token_files as tf
from clickpulse.llm.common import text_bytes
from tests.llm.helpers import SCHEMA, key, no_documents, odd_rows, words

FILE = public_tokenizers.path("byte_bpe_50k.json")


def encoded(rows, end=2):
    """Ids of every row by the library, rows by id; equal ids in any order."""
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return [(r[0], [*t.encode(r[1] or "", add_special_tokens=False).ids, end]) for r in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def rows():
    more = [(100 + i, words(i, 40 + i), "en", None, None, "x", 1, 2, 3) for i in range(200)]
    hot = [(55, "a hot text", "en", None, None, "x", 1, 2, 3)] * 120  # a third of all rows
    return odd_rows() + more + hot


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "out")
    tf.write_tokens(spark.createDataFrame(rows, SCHEMA).repartition(4), path, FILE, meta=("lang", "x"),
                    file_text_bytes=200_000, page_rows=16)
    return path


def test_digest_equals_the_library(spark, rows, folder):
    got = tf.token_digest(spark, folder).orderBy("start").collect()
    want = encoded(rows)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) \
        == sorted(((i, len(x), crc(x)) for i, x in want), key=key)
    at = 0
    for r in got:  # gapless, ids ascending, null ids first
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] or -1 for r in got] == sorted(i or -1 for i, _ in want)


def test_files_hold_what_they_should(folder):
    files = sorted(glob.glob(f"{folder}/tokens/*.parquet"))
    assert len(files) > 2
    last = -1
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            by_name = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c)
                       for c in range(meta.num_columns)}
            assert "RLE_DICTIONARY" in by_name["ids.list.element"].encodings
            assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings
            assert all(c.has_offset_index for c in by_name.values())
        ids = [i or -1 for i in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()]
        assert ids == sorted(ids) and (not ids or ids[0] >= last)
        last = ids[-1] if ids else last


def test_row_groups_and_delta(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    tf.write_tokens(spark.createDataFrame(rows, SCHEMA), path, FILE, encoding="delta", row_group_bytes=64 << 10,
                    page_rows=10)
    meta = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/tokens/*.parquet")]
    assert sum(m.num_row_groups for m in meta) > len(meta)
    names = [meta[0].row_group(0).column(c) for c in range(meta[0].num_columns)]
    assert [c.encodings for c in names if c.path_in_schema == "ids.list.element"] == [("DELTA_BINARY_PACKED", "RLE")] \
        or "DELTA_BINARY_PACKED" in [c for c in names if c.path_in_schema == "ids.list.element"][0].encodings
    got = {(r["doc_id"], r["ids_crc32"]) for r in tf.token_digest(spark, path).collect()}
    assert got == {(i, crc(x)) for i, x in encoded(rows)}
    with pytest.raises(ValueError):
        tf.write_tokens(spark.createDataFrame(rows, SCHEMA), path, FILE, encoding="plain")


def test_ranges_of_ids_and_of_positions(spark, rows, folder):
    want = {i: x for i, x in encoded(rows)}
    part = tf.documents(spark, folder, 110, 119).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in part} == {i: want[i] for i in range(110, 120)}
    everything = [(r["doc_id"], r["start"], list(r["ids"]))
                  for r in tf.documents(spark, folder).orderBy("start").collect()]
    flat = [t for _, _, ids in everything for t in ids]
    for start, stop in ((0, 1), (17, 500), (len(flat) - 3, len(flat) + 10), (100, 60_000), (9, 9)):
        got = tf.tokens_between(spark, folder, start, stop).orderBy("start").collect()
        assert [t for r in got for t in r["ids"]] == flat[start:stop]


def test_metadata_reads_no_ids(spark, folder, capsys):
    meta = tf.metadata(spark, folder, 110, 119)
    assert {(r["doc_id"], r["meta"]["lang"], r["meta"]["x"]) for r in meta.collect()} == {(i, "en", 3) for i in range(110, 120)}
    meta.explain()
    plan = capsys.readouterr().out
    assert "ids" not in plan and "GreaterThanOrEqual(doc_id,110)" in plan


def test_long_texts_are_cut_where_pretokens_begin(monkeypatch):
    monkeypatch.setattr(tf, "PIECE", 37)
    text = words(3, 500) + "  x\n\n y 12 ½ don't it's  " + "q" * 90 + " 日本語 テキスト " + words(4, 90)
    encoder = tf.Encoder(FILE)
    assert np.frombuffer(encoder.ids(text.encode()), np.uint32).tolist() == encoded([(1, text)])[0][1][:-1]
    monkeypatch.setattr(tf, "KNOWN", 5)
    assert np.frombuffer(tf.Encoder(FILE).ids(text.encode()), np.uint32).tolist() == encoded([(1, text)])[0][1][:-1]


def test_pretokens_in_use_stay_known(monkeypatch):
    monkeypatch.setattr(tf, "KNOWN", 60)
    encoder, calls = tf.Encoder(FILE), []
    tokenize = encoder.tokenize
    encoder.tokenize = lambda word: calls.append(word) or tokenize(word)
    hot = "".join(f" hot{chr(97 + i)}" for i in range(26)) + "".join(f" warm{chr(97 + i)}" for i in range(14))
    texts = [hot + "".join(f" new{chr(97 + k)}{chr(97 + i)}" for i in range(15)) for k in range(8)]
    for text in texts:
        assert np.frombuffer(encoder.ids(text.encode()), np.uint32).tolist() == encoded([(1, text)])[0][1][:-1]
    assert len(calls) == len(set(calls)) == 40 + 8 * 15  # each is encoded once, though more than KNOWN occur


@pytest.mark.parametrize("piece, block", [(1 << 20, 8 << 20), (60, 8 << 20), (1 << 20, 1), (60, 500)])
def test_texts_in_runs_and_blocks(monkeypatch, rows, piece, block):
    monkeypatch.setattr(tf, "PIECE", piece)
    monkeypatch.setattr(tf, "BLOCK_BYTES", block)
    rows = [r for r in rows if len(r[1] or "") < 20_000]
    items = [text_bytes(pa.array([r[1] for r in rows[i:i + 23]], pa.string())) for i in range(0, len(rows), 23)]
    end, got = np.array([2], np.uint32).tobytes(), []
    for ends, flat in tf.Encoder(FILE).texts(iter(items), end):
        got += [flat[i:j].tolist() for i, j in zip(ends[:-1], ends[1:])]
    assert got == [x for _, x in encoded(rows)]


def test_offsets_over_many_files(spark, monkeypatch):
    monkeypatch.setattr(tf, "PARTS_PER_BLOCK", 3)
    per_file = spark.createDataFrame([(p, 0, 0, 1, 10 + p) for p in range(0, 20, 2)],
                                     "part int, first_id long, last_id long, n_rows long, n_tokens long")
    got = {r["part"]: r["offset"] for r in tf._offsets(per_file).collect()}
    assert got == {p: sum(10 + q for q in range(0, p, 2)) for p in range(0, 20, 2)}


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "out")
    tf.write_tokens(no_documents(spark), path, FILE)
    assert tf.token_digest(spark, path).count() == 0
    assert tf.tokens_between(spark, path, 0, 10).count() == 0
