"""Hand-written edge rows (the cases the driver tables do not reach)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickpulse.functions.text import composite_key, java_split, percent, split_ids, target_flows
from clickpulse.operators import ads, area, category, conversion
from clickpulse.plans.condition import Condition, filter_visits
from clickpulse.sources.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION

from .conftest import rows


def visit(date="2024-01-01", user_id=1, session_id="s1", page_id=1, action_time="2024-01-01 10:00:00",
          click_category_id=-1, click_product_id=-1, order_category_ids=None, pay_category_ids=None,
          city_id=1):
    return (date, user_id, session_id, page_id, action_time, None, click_category_id, click_product_id,
            order_category_ids, None, pay_category_ids, None, city_id)


def visits_df(spark, rs):
    return spark.createDataFrame(rs, USER_VISIT_ACTION)


# ---------------------------------------------------------------- C1
@pytest.mark.parametrize("text,expected", [
    ("", [""]), ("1,,", ["1"]), ("1,,2", ["1", "", "2"]), (",,", []), (",1", ["", "1"]),
    ("7", ["7"]), (None, None),
])
def test_split_ids_like_java(spark, text, expected):
    df = spark.createDataFrame([(text,)], "ids string")
    got = df.select(split_ids(F.col("ids")).alias("a")).first()["a"]
    assert got == expected
    if text is not None:
        assert java_split(text) == expected


# ---------------------------------------------------------------- F5, A1, A2, W2
def test_click_wins_over_order_and_ids_counted(spark):
    v = visits_df(spark, [
        visit(click_category_id=5, order_category_ids="1,2"),  # click only
        visit(order_category_ids="1,,", pay_category_ids="9"),  # order "1" only
        visit(order_category_ids=""),  # one empty id
        visit(pay_category_ids="3,4"),
        visit(),  # nothing
    ])
    got = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"])
           for r in category.category_counts(v).collect()}
    assert got == {"5": (1, 0, 0), "1": (0, 1, 0), "": (0, 1, 0), "3": (0, 0, 1), "4": (0, 0, 1)}


def test_top10_order_and_tie_break(spark):
    rs = [visit(click_category_id=c) for c in range(1, 13) for _ in range(2)]
    rs += [visit(click_category_id=1), visit(order_category_ids="2"), visit(pay_category_ids="2")]
    top = category.category_top10(visits_df(spark, rs), "t").collect()
    ids = [r["category_id"] for r in top]
    assert len(ids) == 10
    assert ids[:2] == ["1", "2"]  # 3 clicks; then 2 clicks + order + pay
    assert ids[2:] == sorted(ids[2:])  # equal counts: text order of the id


def test_session_top10_caps_each_category(spark):
    rs = [visit(session_id=f"s{i:02d}", click_category_id=1) for i in range(15) for _ in range(i % 4 + 1)]
    v = visits_df(spark, rs)
    top = category.category_top10(v, "t")
    got = category.category_session_top10(v, top, "t").collect()
    assert len(got) == 10
    # counts are i % 4 + 1: four 4s... the cut falls inside the 2s (s01, s05, s09, s13)
    assert sorted(r["click_count"] for r in got) == [2, 2, 2, 3, 3, 3, 3, 4, 4, 4]
    twos = sorted(r["session_id"] for r in got if r["click_count"] == 2)
    assert twos == ["s01", "s05", "s09"]  # ties go to the smaller session id


# ---------------------------------------------------------------- R4 edges
def _dims(spark, cities, products):
    return (spark.createDataFrame(cities, CITY_INFO), spark.createDataFrame(products, PRODUCT_INFO))


def test_remark_with_two_and_three_cities(spark):
    cities, products = _dims(spark, [(1, "A", "north"), (2, "B", "north"), (3, "C", "north")],
                             [(1, "p1", "self"), (2, "p2", "self")])
    rs = ([visit(city_id=1, click_product_id=1)] * 3 + [visit(city_id=2, click_product_id=1)]
          + [visit(city_id=1, click_product_id=2)] * 2 + [visit(city_id=2, click_product_id=2)] * 2
          + [visit(city_id=3, click_product_id=2)] * 4)
    got = {r["product_name"]: (r["click_count"], r["city_remark"])
           for r in area.area_product_clicks(visits_df(spark, rs), cities, products).collect()}
    assert got["p1"] == (4, "A:75.00%, B:25.00%")
    # ties between A and B (2 each) go to the smaller name
    assert got["p2"] == (8, "C:50.00%, A:25.00%, 其他:25.00%")


def test_rank_ties_at_three_all_stay(spark):
    cities, products = _dims(spark, [(1, "A", "north")], [(i, f"p{i}", "self") for i in range(1, 6)])
    per = {1: 5, 2: 4, 3: 3, 4: 3, 5: 1}
    rs = [visit(city_id=1, click_product_id=p) for p, n in per.items() for _ in range(n)]
    got = rows(area.area_product_top3(visits_df(spark, rs), cities, products)
               .select("product_name", "rank"))
    assert got == [("p1", 1), ("p2", 2), ("p3", 3), ("p4", 3)]


def test_non_clicks_and_unknown_products_are_left_out(spark):
    cities, products = _dims(spark, [(1, "A", "north")], [(1, "p1", "self")])
    rs = [visit(city_id=1, click_product_id=1), visit(city_id=1, click_product_id=-1),
          visit(city_id=1, click_product_id=7), visit(city_id=9, click_product_id=1)]
    got = area.area_product_clicks(visits_df(spark, rs), cities, products).collect()
    assert [(r["product_name"], r["click_count"], r["city_remark"]) for r in got] == [("p1", 1, "A:100.00%")]


# ---------------------------------------------------------------- C6, C7
def test_percent_patterns(spark):
    df = spark.createDataFrame([(0.005,), (0.1234,), (1.0,), (0.0,)], "x double")
    got = df.select(percent(F.col("x")).alias("a"), percent(F.col("x"), False).alias("b")).collect()
    assert [(r["a"], r["b"]) for r in got] == [
        ("0.50%", ".50%"), ("12.34%", "12.34%"), ("100.00%", "100.00%"), ("0.00%", ".00%")]


# ---------------------------------------------------------------- R3 edges
def _sess(spark, seq, session="s1"):
    rs = [visit(session_id=session, page_id=p, action_time=t) for p, t in seq]
    return visits_df(spark, rs)


def test_pages_outside_the_list_are_removed_before_pairing(spark):
    v = _sess(spark, [(1, "2024-01-01 10:00:00"), (9, "2024-01-01 10:00:01"), (2, "2024-01-01 10:00:02")])
    got = rows(conversion.page_transitions(v, "1,2,3").select("flow", "flow_count"))
    assert got == [("1->2", 1)]


def test_pairs_across_hour_buckets_and_sessions(spark):
    v = _sess(spark, [(1, "2024-01-01 10:59:59"), (2, "2024-01-01 11:00:01"),
                      (3, "2024-01-01 13:30:00"), (1, "2024-01-01 13:30:01")])
    v = v.unionByName(_sess(spark, [(2, "2024-01-01 09:00:00"), (3, "2024-01-01 09:00:01")], "s2"))
    got = rows(conversion.consecutive_pairs(v.select("session_id", "action_time", "page_id")))
    assert got == [(1, 2, 1), (2, 3, 2), (3, 1, 1)]


def test_single_page_flow_and_low_rate(spark):
    v = _sess(spark, [(1, f"2024-01-01 10:{i // 60:02d}:{i % 60:02d}") for i in range(199)]
              + [(2, "2024-01-01 11:00:00")])
    assert conversion.page_conversion(v, "1", "t").count() == 0
    got = conversion.page_conversion(v, "1,2", "t").collect()
    assert [(r["flow"], r["rate"]) for r in got] == [("1->2", ".50%")]
    assert target_flows(["1"]) == []


# ---------------------------------------------------------------- F1-F3, J1
def test_condition_bounds_only_when_set(spark):
    users = spark.createDataFrame([(1, "u", "n", 30, "p", "M"), (2, "u", "n", 60, "p", "F")], USER_INFO)
    v = visits_df(spark, [visit(date="2024-01-01", user_id=1), visit(date="2024-01-03", user_id=1),
                          visit(date="2024-01-02", user_id=2), visit(date="2024-01-02", user_id=3)])
    assert filter_visits(v, users, Condition()).count() == 3  # user 3 has no user row
    c = Condition.from_json('{"startDate": "2024-01-02", "endDate": "", "startAge": "20", '
                            '"endAge": "50", "professionals": "x", "gender": "F"}')
    assert c.start_age == 20 and c.end_date == "" and c.gender == "F"
    got = rows(filter_visits(v, users, c).select("date", "user_id"))
    assert got == [("2024-01-03", 1)]  # gender is carried, never applied


# ---------------------------------------------------------------- S4
def test_malformed_lines_are_rejected_not_fatal(spark):
    lines = spark.createDataFrame([("1700000000000,north,A,101,1",), ("abc,north,A,101,1",),
                                   ("1700000000000,north,A",), ("1700000000000,north,A,101,2,extra",),
                                   ("99999999999999999999,n,A,1,1",), ("1700000000000,north,A,101,",)],
                                  "value string")
    parsed = ads.parse_ad_lines(lines)
    good = rows(ads.good_lines(parsed))
    assert good == [(1700000000000, "north", "A", "101", "1"), (1700000000000, "north", "A", "101", "2")]
    bad = dict((r["line"], r["_error"]) for r in ads.bad_lines(parsed).collect())
    assert bad == {"abc,north,A,101,1": "bad timestamp", "1700000000000,north,A": "too few fields",
                   "99999999999999999999,n,A,1,1": "bad timestamp",
                   "1700000000000,north,A,101,": "too few fields"}


# ---------------------------------------------------------------- R5 edges
def _clicks(spark, rs):
    return spark.createDataFrame(rs, "ts long, area string, city string, user_id string, ads_id string")


def test_user_crossing_threshold_inside_a_slot(spark):
    h = 3_600_000
    base = 1_704_067_200_000  # 2024-01-01 00:00 UTC
    rs = [(base + 1, "n", "A", "7", "1"), (base + 2, "n", "A", "7", "1"),
          (base + h + 1, "n", "A", "7", "1"), (base + h + 2, "n", "A", "7", "1"),
          (base + h + 3, "n", "A", "7", "2"),
          (base + 2 * h + 1, "n", "A", "7", "1"), (base + 2 * h + 5, "n", "A", "8", "1")]
    c = _clicks(spark, rs)
    flags = ads.blacklist_users(c, 3, h).collect()
    assert [(r["user_id"], r["flag_slot"]) for r in flags] == [("7", base // h + 1)]
    kept = ads.blacklist_replay(c, 3, h)
    # every click of the flagging slot passes, the next slot's click of user 7 does not
    assert kept.where("user_id = '7'").count() == 5
    assert kept.where("user_id = '8'").count() == 1
    cnt = rows(ads.user_ad_day_counts(kept))
    assert cnt == [("2024-01-01", "7", "1", 4), ("2024-01-01", "7", "2", 1), ("2024-01-01", "8", "1", 1)]
    assert rows(ads.blacklist_counters(c, 3, h)) == cnt


def test_threshold_is_per_day_and_ad(spark):
    h = 3_600_000
    base = 1_704_067_200_000
    # two per ad per day: never 3 for one (day, ad)
    rs = [(base + d * 24 * h + a, "n", "A", "7", str(a)) for d in range(3) for a in (1, 2) for _ in (0, 1)]
    assert ads.blacklist_users(_clicks(spark, rs), 3, h).count() == 0


# ---------------------------------------------------------------- R7, R8 edges
def test_top3_json_shape_and_order(spark):
    day_ms = 1_704_067_200_000
    rs = [(day_ms, "n", "A", "1", ad) for ad, n in (("1", 3), ("2", 5), ("3", 5), ("4", 1)) for _ in range(n)]
    rs += [(day_ms, "n", "B", "1", "4")] * 4
    ca = ads.day_area_city_ads(_clicks(spark, rs))
    top = ads.day_area_ads_top3(ads.day_area_ads(ca))
    got = ads.day_area_ads_top3_json(top).collect()
    # ads 2, 3, 4 all have 5 clicks (4 summed over two cities); ad 1 is cut
    assert [(r["day"], r["area"], r["ads_json"]) for r in got] == [
        ("2024-01-01", "n", '[{"2":5},{"3":5},{"4":5}]')]


def test_last_hour_across_midnight_sorts_as_text(spark):
    end = 1_704_067_200_000 + 30 * 60_000  # 2024-01-01 00:30 UTC
    rs = [(end - 40 * 60_000, "n", "A", "1", "1"),  # 23:50 the day before
          (end - 5 * 60_000, "n", "A", "1", "1"), (end - 5 * 60_000 + 1, "n", "A", "1", "1"),
          (end - 61 * 60_000, "n", "A", "1", "1"),  # outside the hour
          (end + 5_000, "n", "A", "1", "1")]  # a later batch
    m = ads.last_hour_minutes(_clicks(spark, rs), end)
    got = ads.minutes_json(m).collect()
    assert [(r["ads_id"], r["minutes_json"]) for r in got] == [("1", '[{"00:25":2},{"23:50":1}]')]


def test_last_hour_is_720_slots_with_partial_edge_minutes(spark):
    end = 1_705_320_000_000  # 12:00:00.000, first ms of its 5 s slot
    lo, hi = ads.last_hour_bounds(end, 3_600_000, 5_000)
    assert (hi - lo) == 3_600_000 and hi == end + 5_000
    rs = [(lo - 1, "n", "A", "1", "1"), (lo, "n", "A", "1", "1"),  # 11:00:04.999 out, 11:00:05 in
          (end + 4_999, "n", "A", "1", "1"), (end + 5_000, "n", "A", "1", "1")]
    got = rows(ads.last_hour_minutes(_clicks(spark, rs), end))
    assert got == [("1", "11:00", 1), ("1", "12:00", 1)]


def test_condition_from_properties_file_format():
    text = ('condition.params.json={startDate:"2024-01-05", \\\n'
            '  endDate:"2024-01-20", \\\n  startAge: "20", \\\n  endAge: "50", \\\n'
            '  professionals: "",  \\\n  targetPageFlow:"1,2,3"}\n')
    c = Condition.from_properties(text)
    assert (c.start_date, c.end_date, c.start_age, c.end_age) == ("2024-01-05", "2024-01-20", 20, 50)
    assert c.target_page_flow == "1,2,3" and c.professionals == ""


def test_composite_key_text(spark):
    df = spark.createDataFrame([("north", "A", "3", "2024-01-01")], "area string, city string, ad string, day string")
    got = df.select(composite_key(F.col("area"), F.col("city"), F.col("ad"), F.col("day")).alias("k")).first()["k"]
    assert got == "north:A:3:2024-01-01"


def test_single_scan_r1_r2_equal_separate_forms(spark):
    rs = [visit(session_id=f"s{i % 7}", click_category_id=i % 5 + 1) for i in range(60)]
    rs += [visit(session_id="s9", order_category_ids="-1,2")] * 30  # "-1" becomes a top category
    rs += [visit(session_id="s8", pay_category_ids="3,,")] * 5 + [visit(session_id="s8")]
    v = visits_df(spark, rs)
    top, sessions = category.top_category_sessions(v, "t")
    assert rows(top) == rows(category.category_top10(v, "t"))
    assert "-1" in [r["category_id"] for r in top.collect()]
    # every action whose click category reads "-1" counts for that category
    assert rows(sessions) == rows(category.category_session_top10(v, category.category_top10(v, "t"), "t"))
    assert ("t", "-1", "s9", 30) in rows(sessions)
    assert rows(category.top_category_session_counts(v, "t")) == rows(
        category.category_session_counts(v, category.category_top10(v, "t")))


def test_hash_views_of_stream_results(spark):
    from clickpulse.sources import hashview

    day_ms = 1_704_067_200_000
    c = _clicks(spark, [(day_ms, "n", "A", "1", "2"), (day_ms, "n", "A", "1", "2"), (day_ms, "n", "B", "1", "3")])
    r6 = hashview.day_area_city_ads_hash(ads.day_area_city_ads(c))
    assert rows(r6) == [("area:city:ads:2024-01-01", "n:A:2", "2"), ("area:city:ads:2024-01-01", "n:B:3", "1")]
    top = ads.day_area_ads_top3_json(ads.day_area_ads_top3(ads.day_area_ads(ads.day_area_city_ads(c))))
    assert rows(hashview.day_area_ads_top3_hash(top)) == [("area:ads:top3:2024-01-01", "n", '[{"2":2},{"3":1}]')]
    trend = ads.minutes_json(ads.last_hour_minutes(c, day_ms))
    assert rows(hashview.last_hour_hash(trend)) == [("last:hour:ads", "2", '[{"00:00":2}]'),
                                                    ("last:hour:ads", "3", '[{"00:00":1}]')]
