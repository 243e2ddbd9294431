"""Spark results against small pure-Python models of the original semantics."""

from __future__ import annotations

from collections import Counter
from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickpulse.functions.text import java_split
from clickpulse.operators import area, category, conversion
from clickpulse.sources.schemas import CITY_INFO, PRODUCT_INFO, USER_VISIT_ACTION

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def pct(x: float, leading_zero: bool = True) -> str:
    """DecimalFormat "0.00%" / ".00%": x * 100 in double, half-even on its exact value."""
    text = str(Decimal(x * 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN)) + "%"
    if not leading_zero and text.startswith("0."):
        return text[1:]
    if not leading_zero and text.startswith("-0."):
        return "-" + text[2:]
    return text


def visit(session="s", page=1, time="2024-01-01 00:00:00", click=-1, product=-1, order=None, pay=None, city=1):
    return ("2024-01-01", 1, session, page, time, None, click, product, order, None, pay, None, city)


ids_text = st.one_of(st.none(), st.text(alphabet="123,", max_size=6))


@SETTINGS
@given(st.lists(st.tuples(st.integers(-1, 3), ids_text, ids_text), min_size=1, max_size=25))
def test_category_counts_model(spark, actions):
    rows = [visit(click=c, order=o, pay=p) for c, o, p in actions]
    got = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"])
           for r in category.category_counts(spark.createDataFrame(rows, USER_VISIT_ACTION)).collect()}
    want = Counter()
    for c, o, p in actions:  # first match wins; ids split as String.split does
        if c != -1:
            want[(str(c), "click")] += 1
        elif o is not None:
            for cid in java_split(o):
                want[(cid, "order")] += 1
        elif p is not None:
            for cid in java_split(p):
                want[(cid, "pay")] += 1
    cats = {cid for cid, _ in want}
    assert got == {cid: (want[(cid, "click")], want[(cid, "order")], want[(cid, "pay")]) for cid in cats}


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 3)), min_size=1, max_size=40))
def test_city_remark_model(spark, clicks):
    cities = spark.createDataFrame([(1, "B", "x"), (2, "A", "x"), (3, "C", "x"), (4, "A2", "y")], CITY_INFO)
    products = spark.createDataFrame([(1, "p", "self"), (2, "q", "self"), (3, "p", "self")], PRODUCT_INFO)
    rows = [visit(click=1, product=prod, city=city) for city, prod in clicks]
    got = {(r["area"], r["product_name"]): (r["click_count"], r["city_remark"]) for r in
           area.area_product_clicks(spark.createDataFrame(rows, USER_VISIT_ACTION), cities, products).collect()}
    names = {1: ("B", "x"), 2: ("A", "x"), 3: ("C", "x"), 4: ("A2", "y")}
    pname = {1: "p", 2: "q", 3: "p"}
    groups: dict[tuple, Counter] = {}
    for city, prod in clicks:
        name, ar = names[city]
        groups.setdefault((ar, pname[prod]), Counter())[name] += 1
    want = {}
    for key, counts in groups.items():
        total = sum(counts.values())
        top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
        parts = [f"{name}:{pct(n / total)}" for name, n in top]
        if len(counts) > 2:
            rest = 1.0
            for _, n in top:
                rest -= n / total
            parts.append(f"其他:{pct(rest)}")
        want[key] = (total, ", ".join(parts))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200), st.integers(1, 5)), min_size=1, max_size=40))
def test_page_conversion_model(spark, acts):
    rows = [visit(session=f"s{s}", page=p, time=f"2024-01-01 {t // 60:02d}:{t % 60:02d}:00.{i:06d}")
            for i, (s, t, p) in enumerate(acts)]
    got = {r["flow"]: r["rate"] for r in
           conversion.page_conversion(spark.createDataFrame(rows, USER_VISIT_ACTION), "1,2,3,4", "t").collect()}
    pages = ["1", "2", "3", "4"]
    den = Counter(str(p) for _, _, p in acts if str(p) in pages[:-1])
    by_session: dict[int, list] = {}
    for i, (s, t, p) in enumerate(acts):
        if str(p) in pages:
            by_session.setdefault(s, []).append((f"{t // 60:02d}:{t % 60:02d}:00.{i:06d}", p))
    num = Counter()
    for seq in by_session.values():
        seq.sort()
        for (_, a), (_, b) in zip(seq, seq[1:]):
            if f"{a}->{b}" in {"1->2", "2->3", "3->4"}:
                num[(f"{a}->{b}", str(a))] += 1
    assert got == {flow: pct(n / den[a], leading_zero=False) for (flow, a), n in num.items()}


_T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC
_H = 3_600_000


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 2), st.integers(0, 47 * 60)),
                min_size=1, max_size=60))
def test_blacklist_model(spark, clicks):
    from clickpulse.operators import ads

    threshold = 3
    rows_in = [(_T0 + minute * 60_000 + i, "n", "A", f"u{u}", str(a)) for i, (u, a, minute) in enumerate(clicks)]
    df = spark.createDataFrame(rows_in, "ts long, area string, city string, user_id string, ads_id string")
    got_flags = {r["user_id"]: r["flag_slot"] for r in ads.blacklist_users(df, threshold, _H).collect()}
    got_kept = sorted(tuple(r) for r in ads.blacklist_replay(df, threshold, _H).collect())

    # the loop of the original, one slot (hour) at a time: filter, count, flag
    flags, counts, kept = {}, Counter(), []
    for s in sorted({ts // _H for ts, *_ in rows_in}):
        batch = [r for r in rows_in if r[0] // _H == s]
        batch = [r for r in batch if r[3] not in flags]  # listed users lose later slots
        kept += batch
        for ts, _, _, user, ad in batch:
            counts[(ts // 86_400_000, user, ad)] += 1
        for (day, user, ad), n in counts.items():
            if n >= threshold and user not in flags:
                flags[user] = s
    assert got_flags == flags
    assert got_kept == sorted(kept)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["n", "s"]), st.sampled_from(["A", "B"]),
                          st.integers(1, 5)), min_size=1, max_size=60))
def test_top3_ads_model(spark, clicks):
    import json

    from clickpulse.operators import ads

    rows_in = [(_T0 + d * 86_400_000 + i, area, city, "u", str(ad)) for i, (d, area, city, ad) in enumerate(clicks)]
    df = spark.createDataFrame(rows_in, "ts long, area string, city string, user_id string, ads_id string")
    top = ads.day_area_ads_top3(ads.day_area_ads(ads.day_area_city_ads(df)))
    got = {(r["day"], r["area"]): r["ads_json"] for r in ads.day_area_ads_top3_json(top).collect()}
    per = Counter((f"2024-01-0{d + 1}", area, str(ad)) for d, area, _, ad in clicks)
    want = {}
    for day, area in {(k[0], k[1]) for k in per}:
        ranked = sorted(((ad, n) for (d, a, ad), n in per.items() if (d, a) == (day, area)),
                        key=lambda x: (-x[1], x[0]))[:3]
        want[(day, area)] = json.dumps([{ad: n} for ad, n in ranked], separators=(",", ":"))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(-4_000_000, 200_000), st.integers(1, 3)), min_size=1, max_size=60),
       st.integers(0, 86_399_999))
def test_last_hour_model(spark, clicks, end_offset):
    import datetime as dt
    import json

    from clickpulse.operators import ads

    end = _T0 + end_offset
    rows_in = [(end + off, "n", "A", "u", str(ad)) for off, ad in clicks]
    df = spark.createDataFrame(rows_in, "ts long, area string, city string, user_id string, ads_id string")
    got = {r["ads_id"]: r["minutes_json"] for r in ads.minutes_json(ads.last_hour_minutes(df, end)).collect()}
    last = end // 5_000  # the slot holding "now" and the 719 before it
    per = Counter()
    for ts, _, _, _, ad in rows_in:
        if last - 720 < ts // 5_000 <= last:
            hm = dt.datetime.fromtimestamp(ts / 1000, dt.timezone.utc).strftime("%H:%M")
            per[(ad, hm)] += 1
    want = {}
    for ad in {a for a, _ in per}:
        items = sorted((hm, n) for (a, hm), n in per.items() if a == ad)
        want[ad] = json.dumps([{hm: n} for hm, n in items], separators=(",", ":"))
    assert got == want
