from __future__ import annotations

from clickpulse.llm import quality
from tests.llm import helpers as H


def test_measures_match_brute_force(spark):
    docs = H.odd_documents(spark)
    got = sorted(((r.doc_id, *(r[m] for m in quality.MEASURES)) for r in quality.quality_rules(docs).collect()), key=H.key)
    assert got == sorted(((r[0], *H.repeated_measures(r[1])) for r in H.odd_rows()), key=H.key)


def test_verdict_and_ngram_shares(spark):
    rows = [(1, H.words(1, 100)), (2, "too short"), (3, " ".join([H.words(2, 12)] * 5)),
            (4, "\n".join([H.words(3, 3)] * 10 + [H.words(4, 40)])), (5, H.words(5, 80) + " " + H.words(5, 9))]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        n, chars, *_ , repeat = H.repeated_measures(text)
        failed = n < 10 or 100 * repeat > 20 * n
        assert got[i].base_failed == failed
        for k in quality.NGRAM_LIMITS:
            assert got[i][f"dup_{k}gram_chars"] == H.later_share(text, k)
        bad = any(100 * H.later_share(text, k) > limit * chars for k, limit in quality.NGRAM_LIMITS.items())
        bad |= 100 * got[i].dup_line_chars > quality.LINE_LIMIT * chars
        assert got[i].kept == (not failed and not bad)
    assert got[1].kept and not got[2].kept and not got[3].kept and not got[4].kept


def test_keep_good_passes_rows_whole(spark):
    docs = H.odd_documents(spark)
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    good = {r.doc_id for r in quality.quality_rules(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == good and 5 not in good and 1 in good
    assert all(r._text == "clash" and r.x == 9 for r in kept.collect())


def test_empty_table(spark):
    assert quality.quality_rules(H.no_documents(spark)).count() == 0
    assert quality.keep_good(H.no_documents(spark)).count() == 0


def test_different_long_words_are_different(spark):
    rows = []
    for n in (9, 10, 11):
        a, b = H.mirrored(n)
        rows += [(n, a + "\n" + b + " " + H.words(n, 30)), (20 + n, f"{a} c d e f {b} c d e f " + H.words(n, 30)),
                 (40 + n, f"{a}\n{a}\n{b}")]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert tuple(got[i][m] for m in quality.MEASURES) == H.repeated_measures(text)
