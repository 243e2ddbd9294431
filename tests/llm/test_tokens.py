from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest

from clickpulse.llm import bpe, packing
from tests.llm import helpers as H

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def coder():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def word_coder():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def strange_texts(n: int, seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    pool = [*" \n\t\r\x0b\x0c\x1c\x85\xa0  ''!.,-_", "'s", "'LL", "a", "Z", "é", "Ç", "ß", "µ", "ª", "²", "½", "7", "×", "İ",
            "́", "日", "😀", "ſ", "<|endoftext|>", "the ", "tion"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_byte_bpe_matches_the_library(spark):
    rows = [(i, t) for i, t, *_ in H.odd_rows() if i is not None] + [(100 + i, t) for i, t in enumerate(strange_texts(300))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, chunk int").repartition(4)
    got = bpe.byte_bpe_digest(docs, bpe.ByteBpe(RANKS), chunk_bytes=3_000, bucket_bytes=20_000).collect()
    enc, want = coder(), []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(map(tuple, got)) == sorted(want)


def test_blocks_are_handled_run_by_run(monkeypatch):
    # a block of 8 MB was one row, of which every position took 8 bytes several times over
    import pyarrow as pa
    monkeypatch.setattr(bpe.TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 3)))
    scheme, rng = bpe.ByteBpe(RANKS), random.Random(8)
    pool = [H.words(k, 300) + " é日" for k in range(200)]
    texts = [" ".join(rng.choice(pool) for _ in range(5)) for _ in range(650)] + [None, ""]
    batches = [pa.record_batch({"doc_id": pa.array(range(i, min(i + 100, len(texts)))), "text": pa.array(texts[i:i + 100], pa.string())})
               for i in range(0, len(texts), 100)]
    size = sum(len((t or "").encode()) for t in texts)
    assert 6 << 20 < size < bpe.CHUNK_BYTES

    def sent(words, codes):
        tracemalloc.start()
        got = list(bpe._send(batches, scheme.cutter(), 3, bpe.CHUNK_BYTES, words, codes))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 3.5 * size
        return pa.Table.from_batches(got)

    docs, words = sent(False, True), sent(True, False)
    assert all(sum(len((texts[i] or "").encode()) for i in r) <= 1 << 20 for r in docs["doc_ids"].to_pylist())
    ids = pa.concat_tables(bpe._encode_bucket(words.slice(k, 1), scheme.encoder()) for k in range(words.num_rows))
    block, enc, got = bpe.Block(docs, ids), coder(), {}
    for doc_ids, upto, codes in block.runs():
        at, flat = block.token_offsets(upto, codes), block.token_ids(codes)
        got |= {d: flat[i:j].tolist() for d, i, j in zip(doc_ids.to_pylist(), at[:-1], at[1:])}
    assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_pretokens_begin_where_the_pattern_says():
    import pyarrow as pa
    import regex

    from clickpulse.llm.common import text_bytes
    scheme, rng = bpe.ByteBpe(RANKS), random.Random(5)
    pool = list(" '' stmdrevl LSa\n\x1c\x85\u3000é日7²😀-ſ")
    short = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    pattern, cut = regex.compile(scheme.pattern), scheme.cutter()
    for texts in [short + strange_texts(500, 6) + [t or "" for _, t, *_ in H.odd_rows()], *([t] for t in short[:2_000])]:
        offsets, data = text_bytes(pa.array(texts, pa.string()))
        sizes = np.diff(np.r_[cut(offsets, data), len(data)])
        assert sizes.tolist() == [len(w.encode()) for t in texts for w in pattern.findall(t)]
    other = bpe.ByteBpe(RANKS, r"\w+|\W+")
    offsets, data = text_bytes(pa.array(["ab cd", "", "é!"]))
    assert other.cutter()(offsets, data).tolist() == [0, 2, 3, 5, 7]
    with pytest.raises(ValueError):
        bpe.ByteBpe(RANKS, r"\w+").cutter()(offsets, data)


def test_ids_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(strange_texts(40, 9))]
    got = bpe.byte_bpe_ids(spark.createDataFrame(rows, "doc_id long, text string"), bpe.ByteBpe(RANKS)).collect()
    enc = coder()
    assert {r.doc_id: (list(r.ids), r.decoded) for r in got} == {i: (enc.encode_ordinary(t), t) for i, t in rows}


def test_words_match_the_library():
    scheme, enc = packing.WordBpe(WORDS), word_coder()
    split, encode = scheme.splitter(), scheme.encoder()
    for text in strange_texts(600, 4) + [t for _, t, *_ in H.odd_rows() if t]:
        got = [i for ids in encode(split(text.encode())) for i in ids]
        assert got == enc.encode(text, add_special_tokens=False).ids, text


def verify(rows, got, window):
    enc, by, sequences = word_coder(), {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, t in rows:
        ids, at = [*enc.encode(t or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(by[i], key=lambda r: r.start):
            own = np.array(ids[at:at + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(own.tobytes()))
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert sorted(sequences) == list(range(len(sequences)))
    return padding


def test_packing_is_exact_and_tight(spark):
    rows = [(i, t) for k, (i, t, *_) in enumerate(H.odd_rows()) if i is not None and i not in (8, 9)]
    rows += [(1000 + k, H.words(k % 300, 1 + k % 170)) for k in range(1500)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, length int, piece int").repartition(4)
    got = packing.pack_documents(docs, WORDS, window=512, known=40).collect()
    assert verify(rows, got, 512) < 0.01 * sum(r.length for r in got)


def test_thinly_dealt_documents_share_files(spark):
    rows = [(k, H.words(k, 1 + k % 60)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(60)
    found = packing.pieces(docs, packing.WordBpe(WORDS), 16)
    assert len(found.inputFiles()) == 1  # once a file for each of the 60 tasks
    numbers = [r.piece for r in found.collect()]
    assert len(set(numbers)) == len(numbers) and len({n >> 33 for n in numbers}) == 60  # numbered where they were cut
    got = packing.pack_documents(docs, WORDS, window=16)
    assert got.rdd.getNumPartitions() == 1
    verify(rows, got.collect(), 16)


def test_pieces_share_files_up_to_a_limit(spark, monkeypatch):
    rows = [(k, H.words(k, 3)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    monkeypatch.setattr(packing, "PER_TASK", 100)
    found = packing.pieces(docs, packing.WordBpe(WORDS))
    assert len(found.inputFiles()) == 4
    verify(rows, packing.pack(found).collect(), 2048)
    monkeypatch.setattr(packing, "PER_TASK", 1)  # not more than the session shuffles to
    assert len(packing.pieces(docs, packing.WordBpe(WORDS)).inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (None, "")], "doc_id long, text string")
    got = packing.pack_documents(docs, WORDS).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 1), (0, 1), (1, 3), (1, 3)]
    assert sorted(r.offset for r in got) in ([0, 0, 0, 1], [0, 1, 2, 5], [0, 1, 4, 5], [0, 0, 1, 2], [0, 3, 6, 7], [0, 1, 2, 3])


@pytest.mark.parametrize("counts", [{700: 3, 600: 2, 48: 9, 5: 1}, {1500: 4, 1000: 1}, {3: 1000}, {2047: 5, 1: 3}, {1: 1}])
def test_plan_uses_every_piece_once(counts):
    used = {}
    for pattern, times in packing.plan(dict(counts), 2048):
        assert times > 0 and sum(k * n for k, n in pattern.items()) <= 2048
        for size, n in pattern.items():
            used[size] = used.get(size, 0) + n * times
    assert used == counts


def test_fullest_window_against_all_multisets():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        sums = {0}
        for size, n in counts.items():
            sums = {s + size * k for s in sums for k in range(n + 1) if s + size * k <= 64}
        got = packing.fullest(counts, 64)
        assert all(0 < n <= counts[size] for size, n in got.items())
        total = sum(size * n for size, n in got.items())
        exact = [s for s in sums if s and s & (s - 1) == 0]
        assert total == (64 if 64 in sums else max(exact) if exact else max(sums))


def test_empty_table(spark):
    assert bpe.byte_bpe_digest(H.no_documents(spark), bpe.ByteBpe(RANKS)).count() == 0
    assert packing.pack_documents(H.no_documents(spark), WORDS).count() == 0
