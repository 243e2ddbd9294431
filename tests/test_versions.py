"""Versioned tables: what readers see, retries, compaction, removal."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.session import scratch_dir
from clickpulse.sources import versions
from clickpulse.sources.versions import CommitLog, VersionedTable

from .conftest import rows

SCHEMA = T.StructType([T.StructField("day", T.StringType()), T.StructField("k", T.StringType()),
                       T.StructField("n", T.LongType())])


def _df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _table(spark, kind, keys=(), parts=(), every=100):
    base = scratch_dir(spark, "vt")
    return VersionedTable(f"{base}/t", SCHEMA, CommitLog(f"{base}/log"), kind, list(keys), list(parts), every)


def _put(spark, t, version, data):
    t.write(_df(spark, data), version)
    t.log.commit(spark, version)
    t.tidy(spark, version)


@pytest.mark.parametrize("every", [1, 2, 3, 100])
def test_sums_and_groups_survive_compaction(spark, every):
    batches = [[("d1", "a", 1), ("d1", "b", 1)], [("d1", "a", 2)], [("d2", "a", 5)], [], [("d1", "b", 7), ("d2", "c", 1)]]
    total = _table(spark, "sum", ["day", "k"], ["day"], every)
    latest = _table(spark, "latest", ["day"], ["day"], every)
    for v, data in enumerate(batches):
        _put(spark, total, v, data)
        _put(spark, latest, v, data)
    assert rows(total.current(spark)) == [("d1", "a", 3), ("d1", "b", 8), ("d2", "a", 5), ("d2", "c", 1)]
    assert rows(total.current(spark, where=F.col("day") == "d2")) == [("d2", "a", 5), ("d2", "c", 1)]
    only = spark.createDataFrame([("b",)], "k string")
    assert rows(total.current(spark, only=only)) == [("d1", "b", 8)]
    assert rows(latest.current(spark)) == [("d1", "b", 7), ("d2", "c", 1)]


def test_readers_see_committed_versions_only(spark):
    t = _table(spark, "sum", ["day", "k"])
    _put(spark, t, 0, [("d", "a", 1)])
    t.write(_df(spark, [("d", "a", 10)]), 1)  # the batch fails before its commit
    assert rows(t.current(spark)) == [("d", "a", 1)]
    t.write(_df(spark, [("d", "a", 5)]), 1)  # and is run again
    t.log.commit(spark, 1)
    assert rows(t.current(spark)) == [("d", "a", 6)]


def test_whole_table_goes_empty_with_an_empty_version(spark):
    t = _table(spark, "whole")
    _put(spark, t, 0, [("d", "a", 1)])
    _put(spark, t, 1, [])
    assert rows(t.current(spark)) == []


def test_second_reader_follows_the_writer(spark):
    t = _table(spark, "log", every=2)
    _put(spark, t, 0, [("d", "a", 0)])
    reader = VersionedTable(t.path, SCHEMA, CommitLog(t.log.path), "log", compact_every=2)
    assert reader.current(spark).count() == 1
    for v in range(1, 8):
        _put(spark, t, v, [("d", "a", v)])
        assert reader.current(spark).count() == v + 1


def test_unreadable_state_is_an_error(spark):
    t = _table(spark, "sum", ["day", "k"])
    _put(spark, t, 0, [("d", "a", 1)])
    fs, p = versions._fs(spark, t.version_path(0))
    for name in versions.names(spark, t.version_path(0)):
        if name.endswith(".parquet"):
            out = fs.create(versions._fs(spark, f"{t.version_path(0)}/{name}")[1], True)
            out.write(bytearray(b"not a parquet file"))
            out.close()
    with pytest.raises(Exception):  # noqa: B017 - never read as "no state"
        t.current(spark).collect()


def test_size_stays_flat(spark):
    t = _table(spark, "sum", ["day", "k"], every=4)
    whole = _table(spark, "whole")
    held = []
    for v in range(70):
        _put(spark, t, v, [("d", "a", 1)])
        held.append(len(versions.names(spark, f"{t.path}/data")) + len(versions.names(spark, f"{t.path}/runs")))
        if v < 63:
            _put(spark, whole, v, [("d", "a", v)])
    assert rows(t.current(spark)) == [("d", "a", 70)]
    assert (0, 63) in t.runs(spark)  # 4 x 4 x 4 versions in one run
    # fewer than four folders per power of four, and what the last merge replaced
    assert max(held) <= 3 * 4 + 2 * 4 and held[-1] <= 4 + 4 + 3
    assert len(versions.names(spark, f"{whole.path}/data")) <= versions.KEEP_WHOLE
    assert len(versions.names(spark, t.log.path)) <= CommitLog.KEEP


def _files(spark, df):
    return sorted(f for f in df.inputFiles())


def _written(spark, path):
    """{file: bytes} of the data files below a folder."""
    fs, p = versions._fs(spark, path)
    out, it = {}, fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        if f.getPath().getName().endswith(".parquet"):
            out[f.getPath().toString()] = f.getLen()
    return out


def test_a_read_opens_the_buckets_of_its_keys(spark):
    base = scratch_dir(spark, "vt")
    t = VersionedTable(f"{base}/t", SCHEMA, CommitLog(f"{base}/log"), "sum", ["day", "k"], ["k"], 3, buckets=8)
    for v in range(5):
        _put(spark, t, v, [(f"d{v}", f"k{i}", i) for i in range(100)])
    only = spark.createDataFrame([("k7",), ("k8",)], "k string")
    part, everything = t.current(spark, only=only), t.current(spark)
    buckets = {f.split("bucket=")[1].split("/")[0] for f in _files(spark, part)}
    assert len(buckets) <= 2 and len(_files(spark, part)) < len(_files(spark, everything)) / 2
    assert rows(part) == sorted((f"d{v}", f"k{i}", i) for v in range(5) for i in (7, 8))
    assert everything.count() == 5 * 99  # sums of zero are gone


def test_merges_rewrite_their_own_stretch_only(spark):
    base = scratch_dir(spark, "vt")
    t = VersionedTable(f"{base}/t", SCHEMA, CommitLog(f"{base}/log"), "sum", ["day", "k"], ["day"], 3, buckets=4)
    _put(spark, t, 0, [("old", f"k{i}", 1) for i in range(5000)])
    for v in range(1, 9):
        _put(spark, t, v, [(f"d{v}", "a", 1)])
    big = {f: n for f, n in _written(spark, f"{t.path}/runs").items() if n > 10_000}
    assert len(big) == 2  # merged at 3 versions and at 9
    before = _written(spark, t.path)
    for v in range(9, 18):
        _put(spark, t, v, [(f"d{v}", "a", 1)])
        new = {f: n for f, n in _written(spark, t.path).items() if f not in before}
        assert sum(new.values()) < 9 * 4 * 2_000 and not any("r=0-" in f for f in new), new
    assert (9, 17) in t.runs(spark)
    days = t._read(spark, [f"{t.path}/runs/r=9-17"]).select("day").distinct()
    assert rows(days) == sorted((f"d{v}",) for v in range(9, 18))
    assert t.current(spark).count() == 5017


def test_late_rows_and_merges_keep_the_least(spark):
    t = _table(spark, "min", ["day", "k"], ["day"], 2)
    for v, n in enumerate([9, 4, 6, 3, 8]):
        _put(spark, t, v, [("d", "a", n), ("d", f"b{v}", v)])
    assert rows(t.current(spark))[0] == ("d", "a", 3) and t.current(spark).count() == 6


def test_a_changed_merge_width_counts_nothing_twice(spark):
    t = _table(spark, "sum", ["day", "k"], ["day"], 3)
    for v in range(30):
        t.compact_every = 3 if v < 11 else 4
        _put(spark, t, v, [("d", "a", 1)])
        assert rows(t.current(spark)) == [("d", "a", v + 1)]


def test_a_reader_planned_ten_publishes_ago_still_reads(spark):
    t = _table(spark, "whole")
    _put(spark, t, 0, [("d", "a", 0)])
    old = t.current(spark)
    for v in range(1, 12):
        _put(spark, t, v, [("d", "a", v)])
    assert rows(old) == [("d", "a", 0)]


def test_a_batch_that_is_run_again_keeps_its_clock(spark):
    clock = versions.BatchClock(scratch_dir(spark, "clock"))
    assert [clock.at(spark, 0, 100), clock.at(spark, 0, 900), clock.at(spark, 1, 901)] == [100, 100, 901]
    for b in range(2, 80):
        clock.at(spark, b, b)
    assert len(versions.names(spark, clock.path)) <= versions.BatchClock.KEEP
