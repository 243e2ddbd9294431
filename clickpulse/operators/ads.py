"""Ad-click jobs R5-R8 as DataFrame -> DataFrame functions.

The same functions run on a static table (batch form, checked against SQL)
and inside ``foreachBatch`` of the stream jobs (:mod:`clickpulse.streaming`).
Input is a clicks frame with ``ts`` (epoch ms), ``area``, ``city``,
``user_id`` and ``ads_id`` (S4, A8-A12, W4, W6, C4, C5, C9, T6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.jsonfmt import pairs_json
from clickpulse.functions.text import split_ids
from clickpulse.functions.timefmt import day_string, hour_minute, slot

AD_FIELDS = ("ts", "area", "city", "user_id", "ads_id")
_LONG_TEXT = r"^[+-]?[0-9]+$"
# Epoch milliseconds of the years 1 to 9999: what the day and minute texts can show.
TS_BOUNDS = (-62_135_596_800_000, 253_402_300_799_999)


# ------------------------------------------------------------------ S4
def parse_ad_lines(lines: DataFrame, col: str = "value", latest_ms: int | None = None) -> DataFrame:
    """``ts,area,city,userid,adid`` text -> typed clicks plus ``_error``.

    Fields are split as ``String.split(",")`` splits them; fields after the
    fifth are ignored. A line with fewer than five fields, with a first field
    that is not a 64-bit integer or lies outside the years 1 to 9999, or (with
    ``latest_ms``) after that instant gets a non-null ``_error`` instead of failing
    the batch; :func:`good_lines` / :func:`bad_lines` split the two.
    """
    parts = lines.select(F.col(col).alias("line"), split_ids(F.col(col), ",").alias("_p"))
    first = F.get("_p", F.lit(0))  # null, not an error, where a field is missing
    out = parts.select(
        "line",
        F.when(first.rlike(_LONG_TEXT), first.try_cast("bigint")).alias("ts"),
        *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(AD_FIELDS) if i > 0],
        F.size("_p").alias("_n"),
    )
    err = (F.when(F.col("_n") < len(AD_FIELDS), F.lit("too few fields"))
           .when(F.col("ts").isNull() | ~F.col("ts").between(*TS_BOUNDS), F.lit("bad timestamp")))
    if latest_ms is not None:
        err = err.when(F.col("ts") > F.lit(latest_ms), F.lit("timestamp ahead of the clock"))
    return out.withColumn("_error", err).drop("_n")


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_error").isNull()).select(*AD_FIELDS)


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_error").isNotNull()).select("line", "_error")


def to_lines(clicks: DataFrame) -> DataFrame:
    """Inverse of :func:`parse_ad_lines`: one text line per click."""
    return clicks.select(F.concat_ws(",", *[F.col(c).cast("string") for c in AD_FIELDS]).alias("value"))


def with_time_text(clicks: DataFrame) -> DataFrame:
    """C4 + C5: ``day`` (yyyy-MM-dd) and ``hm`` (HH:mm) of the click."""
    return clicks.withColumn("day", day_string(F.col("ts"))).withColumn("hm", hour_minute(F.col("ts")))


# ------------------------------------------------------------------ R5
def _slot(at: int | Column) -> Column:
    """The slot of a click: event-time slices of ``at`` ms, or a given column."""
    return at if isinstance(at, Column) else slot(F.col("ts"), at)


def slot_counts(clicks: DataFrame, slot_ms: int | Column) -> DataFrame:
    """A12 per slot: clicks per (user, day, ad, slot); partial aggregate map-side."""
    c = clicks.select("user_id", "ads_id", day_string(F.col("ts")).alias("day"), _slot(slot_ms).alias("slot"))
    return c.groupBy("user_id", "day", "ads_id", "slot").agg(F.count(F.lit(1)).alias("n"))


def flag_users(counts: DataFrame, threshold: int) -> DataFrame:
    """First slot at which a user's running (day, ad) count reaches ``threshold``.

    ``counts`` has user_id, day, ads_id, slot, n (plus an optional ``base``
    count carried from earlier state). The running sum is a window over one
    (user, day, ad) -- at most one row per slot of that day, whatever the
    number of clicks behind it -- so one user's rows spread over its days and
    ads; the minimum per user is aggregated before its shuffle.
    """
    if "base" not in counts.columns:
        counts = counts.withColumn("base", F.lit(0).cast("long"))
    w = (Window.partitionBy("user_id", "day", "ads_id").orderBy("slot")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = counts.withColumn("cum", F.col("base") + F.sum("n").over(w))
    return (cum.where(F.col("cum") >= threshold).groupBy("user_id")
            .agg(F.min("slot").cast("long").alias("flag_slot")))


def kept_clicks(clicks: DataFrame, flags: DataFrame, slot_ms: int | Column) -> DataFrame:
    """F9/J3 replay: a flagged user keeps the clicks up to its flagging slot.

    Clicks of the flagging slot still pass (the filter acts when the next
    batch starts). Joined on user id; the planner may broadcast ``flags``
    when AQE sees it small, and splits a skewed user's partition otherwise.
    """
    c = clicks.withColumn("_slot", _slot(slot_ms))
    j = c.join(flags, "user_id", "left")
    return (j.where(F.col("flag_slot").isNull() | (F.col("_slot") <= F.col("flag_slot")))
            .select(*clicks.columns))


# ------------------------------------------------------------------ S11, J3 for long lists
BLOOM_PROBES = 5
BLOOM_WORDS = 1 << 17  # at most so many 64-bit words: 1 MB


def bloom_bits(key: Column, words: int) -> list[tuple[Column, Column]]:
    """(word, bit mask) of every probe of a key."""
    h = [F.xxhash64(key, F.lit(i)) for i in range(BLOOM_PROBES)]
    return [(F.pmod(F.shiftrightunsigned(x, 6), F.lit(words)).cast("int"),
             F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))) for x in h]


def bloom_filter(keys: DataFrame, col: str, words: int) -> DataFrame:
    """One row, ``bits`` (array of ``words`` longs): a Bloom filter over the keys.

    The bits are or-ed per word before and after the shuffle; what meets in one task is
    the ``words`` longs, whatever the number of keys.
    """
    probes = F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in bloom_bits(F.col(col), words)])
    hit = keys.select(F.explode(probes).alias("p")).groupBy(F.col("p.w").alias("w")).agg(F.bit_or("p.b").alias("b"))
    whole = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("w")).join(hit, "w", "left")
    pairs = F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))))
    return whole.agg(F.transform(pairs, lambda p: p["b"]).alias("bits"))


def might_contain(bits: Column, key: Column, words: int) -> Column:
    """Whether all bits of a key are set: false only for keys that are not in the filter."""
    out = F.lit(True)
    for word, bit in bloom_bits(key, words):
        out = out & (F.get(bits, word).bitwiseAND(bit) != 0)
    return out


def blacklist_users(clicks: DataFrame, threshold: int, slot_ms: int) -> DataFrame:
    """R5 result: users on the blacklist and the slot that put them there."""
    return flag_users(slot_counts(clicks, slot_ms), threshold)


def bloom_words(n: int) -> int:
    """Words for ``n`` keys: about 10 bits a key, a power of two, at most ``BLOOM_WORDS``."""
    words = 64
    while words * 64 < 10 * n and words < BLOOM_WORDS:
        words *= 2
    return words


def kept_clicks_long_list(clicks: DataFrame, flags: DataFrame, slot_ms: int | Column, n_flags: int) -> DataFrame:
    """:func:`kept_clicks` against a list too long to broadcast.

    A Bloom filter over the list (``n_flags`` users, at most ``BLOOM_WORDS`` words; beyond
    about 800,000 users it only lets more clicks through to the join) is probed in the
    scan. Clicks of users that are surely not listed pass there and are never shuffled;
    the others meet the list in an exact join, which decides. ``flags`` is read twice:
    give a written table.
    """
    words = bloom_words(n_flags)
    hit = might_contain(bloom_filter(flags, "user_id", words).scalar(), F.col("user_id"), words)
    return clicks.where(~hit).unionByName(kept_clicks(clicks.where(hit), flags, slot_ms))


def blacklist_replay(clicks: DataFrame, threshold: int, slot_ms: int) -> DataFrame:
    """R5 filter: the clicks the blacklist lets through, slot by slot.

    The flag list has one row per listed user. It is joined without a hint: AQE
    broadcasts it when its real size is small, and splits a hot user's partition
    of the shuffle join otherwise.
    """
    return kept_clicks(clicks, blacklist_users(clicks, threshold, slot_ms), slot_ms)


def user_ad_day_counts(kept: DataFrame) -> DataFrame:
    """The counter table -- kept clicks per (day, user, ad)."""
    return (kept.groupBy(day_string(F.col("ts")).alias("day"), "user_id", "ads_id")
            .agg(F.count(F.lit(1)).alias("cnt")))


def blacklist_counters(clicks: DataFrame, threshold: int, slot_ms: int) -> DataFrame:
    """A12 in one scan: the counter table computed from slot counts.

    Equal to ``user_ad_day_counts(blacklist_replay(...))`` without joining the
    flags back to raw clicks: they are joined to the slot counts, which have one
    row per (user, day, ad, slot), never one per click.
    """
    counts = slot_counts(clicks, slot_ms)
    flags = flag_users(counts, threshold).select(F.col("user_id").alias("flagged"), "flag_slot")
    # null-safe: a plain equality would filter nulls out of one of the two uses of the
    # counts, and their scan and shuffle could not be shared (clicks without a user stay)
    same = F.col("user_id").eqNullSafe(F.col("flagged"))
    flagged = counts.join(flags, same, "left")
    kept = flagged.where(F.col("user_id").isNull() | F.col("flag_slot").isNull() | (F.col("slot") <= F.col("flag_slot")))
    return kept.groupBy("day", "user_id", "ads_id").agg(F.sum("n").cast("long").alias("cnt"))


# ------------------------------------------------------------------ R6, R7
def day_area_city_ads(clicks: DataFrame) -> DataFrame:
    """Clicks per (day, area, city, ad)."""
    return (clicks.groupBy(day_string(F.col("ts")).alias("day"), "area", "city", "ads_id")
            .agg(F.count(F.lit(1)).alias("cnt")))


def day_area_ads(city_counts: DataFrame) -> DataFrame:
    """R6 counts rolled up over cities to (day, area, ad)."""
    return (city_counts.groupBy("day", "area", "ads_id")
            .agg(F.sum("cnt").cast("long").alias("cnt")))


def day_area_ads_top3(area_counts: DataFrame, top: int = 3) -> DataFrame:
    """At most ``top`` ads per (day, area) by count desc; ties by ad id."""
    w = Window.partitionBy("day", "area").orderBy(F.desc("cnt"), F.asc("ads_id"))
    return (area_counts.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= top))


def day_area_ads_top3_json(top3: DataFrame) -> DataFrame:
    """A9 + C9: per (day, area) the ranked ads as ``[{"ad":count},...]``.

    Each list holds at most ``top`` entries, so the collect is bounded.
    """
    g = top3.groupBy("day", "area").agg(
        F.array_sort(F.collect_list(F.struct("rank", "ads_id", "cnt"))).alias("_ads"))
    return g.select("day", "area", pairs_json(F.col("_ads"), "ads_id", "cnt").alias("ads_json"))


# ------------------------------------------------------------------ R8
def last_hour_bounds(end_ms: int, span_ms: int, slot_ms: int) -> tuple[int, int]:
    """[lo, hi) in ms of the ``span_ms / slot_ms`` slots up to and including ``end_ms``'s slot."""
    last = end_ms // slot_ms
    n = span_ms // slot_ms
    return (last - n + 1) * slot_ms, (last + 1) * slot_ms


def last_hour_minutes(clicks: DataFrame, end_ms: int, span_ms: int = 3_600_000,
                      slot_ms: int = 5_000) -> DataFrame:
    """A10 + T3: clicks per (ad, HH:mm) over the last hour of batch slots.

    The original window covers the last 60 min of 5 s batches and labels
    each click by its own minute; the replay uses event-time slots: the
    ``span_ms / slot_ms`` slots up to and including the one holding
    ``end_ms``, so the oldest and newest minute are partial (61 labels).
    The range is on the derived ``ts``; give it to the source as well
    (``MallTables.ads(lo_ms, hi_ms)``) and it reaches the scan.
    """
    lo, hi = last_hour_bounds(end_ms, span_ms, slot_ms)
    c = clicks.where((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi)))
    return (c.groupBy("ads_id", hour_minute(F.col("ts")).alias("hm"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def pane_counts(clicks: DataFrame, slot_ms: int, at: Column | None = None) -> DataFrame:
    """T3 panes: clicks per (ad, slot, HH:mm), each click in one pane.

    The slot is that of the click, or of the instant ``at`` (ms); the label is the click's own minute.
    """
    return (clicks.groupBy("ads_id", slot(F.col("ts") if at is None else at, slot_ms).alias("slot"),
                           hour_minute(F.col("ts")).alias("hm"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def slide_minutes(panes: DataFrame, lo_ms: int, hi_ms: int, span_ms: int = 3_600_000,
                  slot_ms: int = 5_000) -> DataFrame:
    """T3 at every slide: (slot, ads_id, hm, cnt) for the windows that end with each slot in [lo_ms, hi_ms).

    A window is the ``span_ms / slot_ms`` slots up to its own. A pane is stored once and
    enters ``span_ms / slot_ms`` sums; a native sliding window would copy each click that
    often. Panes are cut into stretches of one span per (ad, label): the sums of a stretch
    need its own panes and those of the stretch before, so a window function sees at
    most three spans of slots however many clicks, slots or days there are.
    """
    n, lo, hi = span_ms // slot_ms, lo_ms // slot_ms, -(-hi_ms // slot_ms)
    near = panes.where((F.col("slot") > lo - n) & (F.col("slot") < hi))
    # the slides on which a pane can be seen: its own slot and the n - 1 after it
    stretch = F.floor(F.col("slot") / n)
    two = near.withColumn("stretch", F.explode(F.array(stretch, stretch + 1)))
    first = F.greatest(F.min("slot"), F.col("stretch") * n, F.lit(lo))
    last = F.least(F.max("slot") + (n - 1), (F.col("stretch") + 1) * n - 1, F.lit(hi - 1))
    grid = (two.groupBy("ads_id", "hm", "stretch").agg(first.alias("a"), last.alias("b")).where("a <= b")
            .select("ads_id", "hm", "stretch", F.explode(F.sequence("a", "b")).alias("slot"))
            .select("*", F.lit(0).cast("long").alias("cnt"), F.lit(True).alias("slide")))
    rows = grid.unionByName(two.select("ads_id", "hm", "stretch", "slot", "cnt", F.lit(False).alias("slide")))
    w = Window.partitionBy("ads_id", "hm", "stretch").orderBy("slot").rangeBetween(1 - n, Window.currentRow)
    return (rows.withColumn("cnt", F.sum("cnt").over(w))
            .where(F.col("slide") & (F.col("cnt") > 0))
            .select("slot", "ads_id", "hm", "cnt"))


def slides_json(minutes: DataFrame) -> DataFrame:
    """Per slide and ad, the minutes as JSON like :func:`minutes_json`."""
    g = minutes.groupBy("slot", "ads_id").agg(F.array_sort(F.collect_list(F.struct("hm", "cnt"))).alias("_m"))
    return g.select("slot", "ads_id", pairs_json(F.col("_m"), "hm", "cnt").alias("minutes_json"))


def minutes_json(minutes: DataFrame) -> DataFrame:
    """A11 + W6 + C9: per ad, ``[{"HH:mm":count},...]`` in text order of HH:mm.

    One hour holds at most 61 minute labels, so each list is bounded.
    """
    g = minutes.groupBy("ads_id").agg(F.array_sort(F.collect_list(F.struct("hm", "cnt"))).alias("_m"))
    return g.select("ads_id", pairs_json(F.col("_m"), "hm", "cnt").alias("minutes_json"))
