"""Streams whose clicks come late or out of order, batches that are run again, state kept by the engine."""

from __future__ import annotations

import itertools

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickpulse.operators import ads, area
from clickpulse.session import scratch_dir
from clickpulse.sources.fixtures import MallTables
from clickpulse.sources.streams import text_lines
from clickpulse.streaming import app, replay, running

from .conftest import SF_SMALL, rows

HOUR = 3_600_000
DAY = 24 * HOUR
T0 = 1_704_067_200_000  # 2024-01-01 UTC
CLICK = "ts long, area string, city string, user_id string, ads_id string"


def _df(spark, rs):
    return spark.createDataFrame(rs, CLICK)


def _hours(user, *hours, ad="1", area_name="n"):
    return [(T0 + h * HOUR + k, area_name, "A", user, ad) for k, h in enumerate(hours)]


def _replay(spark, batches, threshold, jobs=("R5",), **options):
    return replay.replay(spark, [_df(spark, b) for b in batches], jobs, threshold, HOUR, now_ms=T0 + 20 * DAY,
                         keep_clicks=True, name="t-late", **options)


def _equals_batch_form(spark, rt, clicks, threshold):
    assert rows(rt.blacklist.current_blacklist(spark)) == rows(ads.blacklist_users(clicks, threshold, HOUR))
    kept = ads.blacklist_replay(clicks, threshold, HOUR)
    assert rows(rt.blacklist.kept_clicks(spark)) == rows(kept)
    assert rows(rt.blacklist.current_counters(spark)) == rows(ads.user_ad_day_counts(kept))
    return kept


def test_a_late_click_counts_in_its_own_slot(spark):
    # hours 10 and 12, then a late click at hour 2: the third click in time is that of hour 12
    batches = [_hours("u", 10), _hours("u", 12), _hours("u", 2), _hours("u", 13) + _hours("v", 1)]
    rt = _replay(spark, batches, 3)
    assert rows(rt.blacklist.current_blacklist(spark)) == [("u", T0 // HOUR + 12)]
    _equals_batch_form(spark, rt, _df(spark, sum(batches, [])), 3)


def test_a_flag_moves_to_an_earlier_slot_and_clicks_are_taken_back(spark):
    batches = [_hours("u", 10, 12, 14) + _hours("w", 5), _hours("u", 30, area_name="s") + _hours("u", 11),
               _hours("u", 9, 8), _hours("x", 7)]
    rt = _replay(spark, batches, 3, ("R5", "R6"))
    clicks = _df(spark, sum(batches, []))
    kept = _equals_batch_form(spark, rt, clicks, 3)
    assert rows(rt.day_area.current_counts(spark)) == rows(ads.day_area_city_ads(kept))
    top3 = ads.day_area_ads_top3(ads.day_area_ads(ads.day_area_city_ads(kept)))
    assert rows(rt.day_area.current_top3(spark)) == rows(top3.select("day", "area", "ads_id", "cnt", "rank"))
    totals = rt.totals(spark).collect()
    assert all(t.lines == t.kept + t.blacklisted + t.rejected for t in totals)
    assert sum(t.kept - t.taken_back for t in totals) == kept.count() and sum(t.taken_back for t in totals) > 0


def test_a_day_whose_clicks_are_all_taken_back_leaves_the_ranking(spark):
    batches = [_hours("u", 30, area_name="s") + _hours("w", 1), _hours("u", 1, 2)]  # flagged on the first day after all
    rt = _replay(spark, batches, 2, ("R5", "R6"))
    _equals_batch_form(spark, rt, _df(spark, sum(batches, [])), 2)
    assert {r.day for r in rt.day_area.current_top3(spark).collect()} == {"2024-01-01"}
    assert {r.day for r in rt.day_area.current_counts(spark).collect()} == {"2024-01-01"}


def test_every_order_of_arrival_gives_one_list(spark):
    parts = [_hours("u", 3, 5), _hours("u", 4) + _hours("v", 2), _hours("u", 1) + _hours("v", 9, 9)]
    clicks = _df(spark, sum(parts, []))
    for order in itertools.islice(itertools.permutations(parts), 1, 6, 2):
        _equals_batch_form(spark, _replay(spark, order, 3), clicks, 3)


@pytest.fixture(scope="module")
def unordered(spark):
    clicks = MallTables(spark, SF_SMALL).ads()
    rt = replay.replay(spark, replay.slices(clicks, 5, unordered=True), ("R5", "R6", "R8"), 3, HOUR,
                       now_ms=T0 + 2 * DAY, max_ahead_ms=60 * DAY, keep_clicks=True, name="t-unordered-all")
    return clicks, rt


def test_all_tables_of_an_unordered_replay_equal_the_batch_forms(spark, unordered):
    clicks, rt = unordered
    kept = _equals_batch_form(spark, rt, clicks, 3)
    assert kept.count() < clicks.count()
    assert rows(rt.day_area.current_counts(spark)) == rows(ads.day_area_city_ads(kept))
    assert rows(rt.last_hour.current_trend(spark)) == rows(ads.minutes_json(ads.last_hour_minutes(kept, T0 + 2 * DAY)))


def test_slides_of_the_stored_panes_equal_single_trends(spark, unordered):
    _, rt = unordered
    end = T0 + 2 * DAY
    slides = rt.last_hour.trend_slides(spark, end, end + 90 * 60_000)
    by_slot = {}
    for r in slides.collect():
        by_slot.setdefault(r.slot, []).append((r.ads_id, r.minutes_json))
    assert len(by_slot) > 300
    for slot in (end // 5000, end // 5000 + 1, end // 5000 + 400, end // 5000 + 719, end // 5000 + 1079):
        assert sorted(by_slot.get(slot, [])) == rows(rt.last_hour.trend_at(spark, slot * 5000))


def test_a_retry_judges_lines_by_the_first_clock(spark):
    """A line ahead of the clock stays a reject when its batch is run again five seconds later."""
    base = scratch_dir(spark, "t-clock")
    now = [T0]
    ads.to_lines(_df(spark, [(T0 - 1, "n", "A", "u", "1"), (T0 + 3_000, "n", "A", "v", "1")])).write.text(f"{base}/src/p=0")
    for attempt in range(2):
        rt = app.realtime_tables(f"{base}/run", 9, now_ms=lambda: now[0], max_ahead_ms=0, keep_clicks=True)
        if attempt == 0:
            def fail(*_):
                raise RuntimeError("simulated loss in the middle of a batch")

            rt.day_area.store = fail
        q = text_lines(spark, f"{base}/src").select("value").writeStream.foreachBatch(rt.batch) \
            .option("checkpointLocation", f"{base}/run/checkpoint").trigger(availableNow=True).start()
        if attempt == 0:
            with pytest.raises(StreamingQueryException):
                q.awaitTermination()
        else:
            q.awaitTermination()
        now[0] += 5_000
    t = rt.totals(spark).collect()
    assert [(r.lines, r.kept, r.blacklisted, r.rejected) for r in t] == [(2, 1, 0, 1)]
    assert rt.rejects(spark).count() == 1
    assert [r.user_id for r in rt.blacklist.kept_clicks(spark).collect()] == ["u"]


def test_a_retry_without_rejects_removes_those_of_the_first_attempt(spark):
    base = scratch_dir(spark, "t-rejects")
    rt = app.realtime_tables(base, 9, now_ms=lambda: T0 + DAY)
    lines = ads.to_lines(_df(spark, _hours("u", 1)))
    rt.batch.rejects.write(spark.createDataFrame([("left behind", "bad timestamp")], app.REJECTS), 0)
    rt.batch(lines, 0)
    assert rt.rejects(spark).count() == 0 and rt.totals(spark).first().rejected == 0


def test_junk_days_bring_no_days_to_the_driver(spark, monkeypatch):
    """A batch of clicks on thousands of days opens at most the buckets, and lists them by number."""
    clicks = spark.range(3000).selectExpr(f"{T0} - id * {DAY} as ts", "'n' as area", "'A' as city",
                                          "concat('u', id) as user_id", "'1' as ads_id")
    rt = replay.replay(spark, [clicks, clicks], ("R5", "R6"), 9, HOUR, name="t-junk")
    assert rt.day_area.current_counts(spark).agg(F.sum("cnt")).first()[0] == 6000
    folders = rt.blacklist.counters.folders(spark, only=clicks.select("user_id"))
    assert len(folders) <= 2 * replay.BUCKETS


def test_running_counts_survive_restarts_and_retries(spark):
    clicks = MallTables(spark, SF_SMALL).ads()
    base = scratch_dir(spark, "t-running")
    for i, part in enumerate(replay.slices(clicks, 3, unordered=True)):
        ads.to_lines(part).write.text(f"{base}/src/part={i}")
        for attempt in range(2 if i == 1 else 1):
            table = running.RunningCounts(f"{base}/run", compact_every=2, buckets=2)
            if i == 1 and attempt == 0:
                def fail(spark, version, log=table.log):
                    raise RuntimeError("simulated loss before the commit")

                table.log.commit = fail
            q = table.start(text_lines(spark, f"{base}/src").select("value"), available_now=True)
            if i == 1 and attempt == 0:
                with pytest.raises(StreamingQueryException):
                    q.awaitTermination()
            else:
                q.awaitTermination()
    assert rows(table.current(spark)) == rows(ads.day_area_city_ads(clicks))


def test_running_counts_can_forget_old_days(spark):
    base = scratch_dir(spark, "t-forget")
    batches = [_hours("u", 1, 25, 26), _hours("u", 24 * 9 + 1), _hours("u", 2, 24 * 9 + 2)]  # the last one's first is late
    for i, b in enumerate(batches):
        ads.to_lines(_df(spark, b)).write.text(f"{base}/src/part={i}")
        table = running.RunningCounts(f"{base}/run", keep_days=2, buckets=2)
        table.start(text_lines(spark, f"{base}/src").select("value"), available_now=True).awaitTermination()
    assert rows(table.current(spark).select("day", "cnt")) == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-10", 2)]


def test_remark_aggregate_in_sql(spark):
    area.register_city_remark(spark)
    spark.createDataFrame([("g", "b", 3), ("g", "a", 3), ("g", None, 2), ("g", "a", 1), ("g", "c", None), ("h", "x", 5),
                           ("i", "p", 1), ("i", "q", 199)], "grp string, city string, n long").createOrReplaceTempView("by_city")
    got = {r.grp: r.remark for r in spark.sql("SELECT grp, city_remark(city, n) AS remark FROM by_city GROUP BY grp").collect()}
    assert got == {"g": "a:44.44%, b:33.33%, 其他:22.22%", "h": "x:100.00%", "i": "q:99.50%, p:0.50%"}
    assert spark.sql("SELECT city_remark(city, n) AS remark FROM by_city WHERE n > 1000 GROUP BY grp").count() == 0


def test_slides_against_a_plain_count(spark):
    import random
    rng = random.Random(4)
    clicks = [(T0 + rng.randrange(4 * HOUR), "n", "A", "u", rng.choice("12")) for _ in range(60)]
    lo, hi, span, width = T0 + HOUR, T0 + 3 * HOUR, 600_000, 60_000
    got = ads.slides_json(ads.slide_minutes(ads.pane_counts(_df(spark, clicks), width), lo, hi, span, width))
    want = set()
    for s in range(lo // width, hi // width):
        for ad in "12":
            n = {}
            for ts, *_, a in clicks:
                if a == ad and s - span // width < ts // width <= s:
                    hm = f"{ts // HOUR % 24:02d}:{ts // 60_000 % 60:02d}"
                    n[hm] = n.get(hm, 0) + 1
            if n:
                want.add((s, ad, "[" + ",".join(f'{{"{k}":{v}}}' for k, v in sorted(n.items())) + "]"))
    assert {tuple(r) for r in got.collect()} == want
