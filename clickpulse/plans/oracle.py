"""Independent DuckDB SQL for every registered query.

Each entry is a complete statement over the driver's base tables (``events``,
``customer``, ``nation``, ``region``, ``part``): the reference-shaped views are
rebuilt as CTEs with the same mapping as :mod:`clickpulse.sources.fixtures`,
then the query is written the plain SQL way (star joins, window functions,
string aggregation). Sums and ranks are cast to BIGINT so both engines agree
on types.
"""

from __future__ import annotations

from clickpulse.plans.params import (
    BLACKLIST_THRESHOLD,
    COND,
    LAST_HOUR_DAY_MS,
    LAST_HOUR_END_MS,
    LAST_HOUR_SLOT_MS,
    LAST_HOUR_SPAN_MS,
    SLOT_MS,
    TASK_ID,
)

_K = "CAST(json_extract(props, '$.k') AS BIGINT)"
_DAY = "strftime(ts, '%Y-%m-%d')"


def _cats(k: str) -> str:
    return (f"CASE WHEN {k} % 3 = 0 THEN CAST({k} % 20 + 1 AS VARCHAR) "
            f"ELSE concat({k} % 20 + 1, ',', ({k} + 7) % 20 + 1) END")


_PRODS = "concat(event_id % 200, ',', (event_id + 11) % 200)"

VIEWS = f"""
ev AS (SELECT *, {_K} AS k FROM events),
user_visit_action AS (
  SELECT {_DAY} AS date, user_id, concat(user_id, '-', {_DAY}) AS session_id,
         k % 10 + 1 AS page_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS action_time,
         CASE WHEN event_type = 'error' THEN concat('kw_', k % 6) END AS search_keyword,
         CASE WHEN event_type IN ('click', 'view') THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type IN ('click', 'view') THEN event_id % 200 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN {_cats('k')} END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN {_PRODS} END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN {_cats('k')} END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN {_PRODS} END AS pay_product_ids,
         (event_id + k) % 25 AS city_id
  FROM ev),
user_info AS (
  SELECT c_custkey AS user_id, concat('user_', c_custkey) AS username, c_name AS name,
         CAST(20 + c_custkey % 41 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey % 10 < 6 THEN 'M' ELSE 'F' END AS gender
  FROM customer),
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         CASE WHEN p_partkey % 10 < 7 THEN 'self' ELSE 'third_party' END AS extend_info
  FROM part),
ads_log AS (
  SELECT epoch_us(e.ts) // 1000 AS ts, c.area, c.city_name AS city,
         CAST(e.user_id % 30 + 101 AS VARCHAR) AS user_id, CAST(e.k % 5 + 1 AS VARCHAR) AS ads_id,
         strftime(e.ts, '%Y-%m-%d') AS day, strftime(e.ts, '%H:%M') AS hm
  FROM ev e JOIN city_info c ON (e.event_id + e.k) % 25 = c.city_id),
filtered_visits AS (
  SELECT v.* FROM user_visit_action v JOIN user_info u ON v.user_id = u.user_id
  WHERE v.date >= '{COND.start_date}' AND v.date <= '{COND.end_date}'
    AND u.age >= {COND.start_age} AND u.age <= {COND.end_age})
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([VIEWS.strip()] + [c.strip() for c in ctes]) + "\n"


def _pct(x: str) -> str:
    """Java ``0.00%`` pattern."""
    return f"printf('%.2f%%', ({x}) * 100)"


def _pct_nolead(x: str) -> str:
    """Java ``.00%`` pattern: like ``0.00%`` without a lone leading zero."""
    return f"regexp_replace({_pct(x)}, '^(-?)0\\.', '\\1.')"


# ---------------------------------------------------------------- R4
_AREA_BY_CITY = """
t1 AS (SELECT c.*, v.click_product_id, p.product_name
       FROM user_visit_action v JOIN city_info c ON v.city_id = c.city_id
       JOIN product_info p ON v.click_product_id = p.product_id
       WHERE v.click_product_id > -1),
bc AS (SELECT area, product_name, coalesce(city_name, 'null') AS city_name, count(*) AS n
       FROM t1 GROUP BY area, product_name, coalesce(city_name, 'null')),
rk AS (SELECT *, row_number() OVER (PARTITION BY area, product_name ORDER BY n DESC, city_name) AS rn,
              sum(n) OVER (PARTITION BY area, product_name) AS total,
              count(*) OVER (PARTITION BY area, product_name) AS ncity
       FROM bc),
t2 AS (SELECT area, product_name, max(total) AS click_count, max(ncity) AS ncity,
              max(CASE WHEN rn = 1 THEN city_name END) AS c1,
              CAST(max(CASE WHEN rn = 1 THEN n END) AS DOUBLE) / max(total) AS r1,
              max(CASE WHEN rn = 2 THEN city_name END) AS c2,
              CAST(max(CASE WHEN rn = 2 THEN n END) AS DOUBLE) / max(total) AS r2
       FROM rk GROUP BY area, product_name),
remark AS (SELECT area, product_name, CAST(click_count AS BIGINT) AS click_count,
       c1 || ':' || """ + _pct("r1") + """
       || coalesce(', ' || c2 || ':' || """ + _pct("r2") + """, '')
       || CASE WHEN ncity > 2 THEN ', 其他:' || """ + _pct("(CAST(1.0 AS DOUBLE) - r1) - r2") + """ ELSE '' END
       AS city_remark
       FROM t2)
"""

AREA_PRODUCT_CITY_COUNTS = _with(_AREA_BY_CITY) + (
    "SELECT area, product_name, city_name, CAST(n AS BIGINT) AS n FROM bc")

CITY_REMARK = _with(_AREA_BY_CITY) + "SELECT * FROM remark"

AREA_PRODUCT_TOP3 = _with(_AREA_BY_CITY) + """
SELECT area, product_name, click_count, city_remark, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS rank FROM remark)
WHERE rank <= 3
"""

# ---------------------------------------------------------------- R1, R2
def _jsplit(x: str) -> str:
    """Java ``split(",")``: trailing empties dropped, ``''`` -> ``['']``."""
    t = f"regexp_replace({x}, ',+$', '')"
    return (f"CASE WHEN {x} = '' THEN [''] WHEN {t} = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE string_split({t}, ',') END")


_CLASSIFIED = f"""
cls AS (SELECT *,
          CASE WHEN click_category_id <> -1 THEN 'click'
               WHEN order_category_ids IS NOT NULL THEN 'order'
               WHEN pay_category_ids IS NOT NULL THEN 'pay' END AS kind,
          CASE WHEN click_category_id <> -1 THEN [CAST(click_category_id AS VARCHAR)]
               WHEN order_category_ids IS NOT NULL THEN {_jsplit('order_category_ids')}
               WHEN pay_category_ids IS NOT NULL THEN {_jsplit('pay_category_ids')} END AS ids
        FROM filtered_visits),
ex AS (SELECT session_id, action_time, kind, unnest(ids) AS category_id FROM cls),
cc AS (SELECT category_id,
              CAST(count(*) FILTER (WHERE kind = 'click') AS BIGINT) AS click_count,
              CAST(count(*) FILTER (WHERE kind = 'order') AS BIGINT) AS order_count,
              CAST(count(*) FILTER (WHERE kind = 'pay') AS BIGINT) AS pay_count
       FROM ex GROUP BY category_id),
top10 AS (SELECT '{TASK_ID}' AS task_id, * FROM cc
          ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
csc AS (SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id,
               CAST(count(*) AS BIGINT) AS click_count
        FROM filtered_visits
        WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10)
        GROUP BY 1, 2)
"""

CONDITION_FILTER = _with() + "SELECT * FROM filtered_visits"
ACTION_CLASSIFY = _with(_CLASSIFIED) + "SELECT session_id, action_time, page_id, kind FROM cls"
EXPLODE_IDS = _with(_CLASSIFIED) + "SELECT * FROM ex"
CATEGORY_COUNTS = _with(_CLASSIFIED) + "SELECT * FROM cc"
CATEGORY_TOP10 = _with(_CLASSIFIED) + "SELECT * FROM top10"
CATEGORY_SESSION_COUNTS = _with(_CLASSIFIED) + "SELECT * FROM csc"
CATEGORY_SESSION_TOP10 = _with(_CLASSIFIED) + f"""
SELECT '{TASK_ID}' AS task_id, category_id, session_id, click_count
FROM (SELECT *, row_number() OVER (PARTITION BY category_id
                                   ORDER BY click_count DESC, session_id) AS rn FROM csc)
WHERE rn <= 10
"""

# ---------------------------------------------------------------- R3
_PAGES = COND.target_page_flow.split(",")
_FLOWS = [f"{a}->{b}" for a, b in zip(_PAGES[:-1], _PAGES[1:])]


def _in_list(xs: list[str]) -> str:
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


_PAGE_FLOW = f"""
den AS (SELECT page_id, count(*) AS page_count FROM filtered_visits
        WHERE CAST(page_id AS VARCHAR) IN {_in_list(_PAGES[:-1])} GROUP BY page_id),
fv AS (SELECT session_id, action_time, page_id FROM filtered_visits
       WHERE CAST(page_id AS VARCHAR) IN {_in_list(_PAGES)}),
pairs AS (SELECT page_id AS from_page,
                 lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id) AS to_page
          FROM fv),
num AS (SELECT from_page || '->' || to_page AS flow, from_page, count(*) AS flow_count
        FROM pairs WHERE to_page IS NOT NULL AND from_page || '->' || to_page IN {_in_list(_FLOWS)}
        GROUP BY 1, 2)
"""

PAGE_DENOMINATOR = _with(_PAGE_FLOW) + "SELECT * FROM den"
PAGE_TRANSITIONS = _with(_PAGE_FLOW) + "SELECT * FROM num"
PAGE_CONVERSION = _with(_PAGE_FLOW) + f"""
SELECT '{TASK_ID}' AS task_id, flow,
       {_pct_nolead('CAST(flow_count AS DOUBLE) / page_count')} AS rate
FROM num JOIN den ON num.from_page = den.page_id
"""

# ---------------------------------------------------------------- R5-R8
_ADS = f"""
sc AS (SELECT *, ts // {SLOT_MS} AS slot FROM ads_log),
ps AS (SELECT user_id, day, ads_id, slot, count(*) AS n FROM sc GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER (PARTITION BY user_id, day, ads_id ORDER BY slot
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM ps),
flags AS (SELECT user_id, CAST(min(slot) AS BIGINT) AS flag_slot
          FROM cum WHERE cum >= {BLACKLIST_THRESHOLD} GROUP BY user_id),
kept AS (SELECT sc.* FROM sc LEFT JOIN flags f ON sc.user_id = f.user_id
         WHERE f.flag_slot IS NULL OR sc.slot <= f.flag_slot),
dac AS (SELECT day, area, city, ads_id, count(*) AS cnt FROM ads_log GROUP BY ALL),
da AS (SELECT day, area, ads_id, CAST(sum(cnt) AS BIGINT) AS cnt FROM dac GROUP BY ALL),
top3 AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY day, area
                                       ORDER BY cnt DESC, ads_id) AS BIGINT) AS rank FROM da)
         WHERE rank <= 3),
lh AS (SELECT ads_id, hm, count(*) AS cnt FROM ads_log
       WHERE ts // {LAST_HOUR_SLOT_MS} > {LAST_HOUR_END_MS // LAST_HOUR_SLOT_MS} - {LAST_HOUR_SPAN_MS // LAST_HOUR_SLOT_MS}
         AND ts // {LAST_HOUR_SLOT_MS} <= {LAST_HOUR_END_MS // LAST_HOUR_SLOT_MS}
       GROUP BY ALL)
"""

ADS_PARSE = _with() + "SELECT ts, area, city, user_id, ads_id, day, hm FROM ads_log"
BLACKLIST_USERS = _with(_ADS) + "SELECT * FROM flags"
BLACKLIST_REPLAY = _with(_ADS) + "SELECT ts, area, city, user_id, ads_id FROM kept"
USER_AD_DAY_COUNTS = _with(_ADS) + (
    "SELECT day, user_id, ads_id, count(*) AS cnt FROM kept GROUP BY ALL")
DAY_AREA_CITY_ADS = _with(_ADS) + "SELECT * FROM dac"
DAY_AREA_ADS = _with(_ADS) + "SELECT * FROM da"
DAY_AREA_ADS_TOP3 = _with(_ADS) + "SELECT * FROM top3"
DAY_AREA_ADS_TOP3_JSON = _with(_ADS) + """
SELECT day, area, '[' || string_agg('{"' || ads_id || '":' || cnt || '}', ',' ORDER BY rank) || ']'
       AS ads_json
FROM top3 GROUP BY day, area
"""
LAST_HOUR_MINUTES = _with(_ADS) + "SELECT * FROM lh"
LAST_HOUR_JSON = _with(_ADS) + """
SELECT ads_id, '[' || string_agg('{"' || hm || '":' || cnt || '}', ',' ORDER BY hm) || ']'
       AS minutes_json
FROM lh GROUP BY ads_id
"""

LAST_HOUR_ALL_SLIDES = _with(_ADS, f"""
pane AS (SELECT ads_id, hm, ts // {LAST_HOUR_SLOT_MS} AS slot, count(*) AS n FROM ads_log GROUP BY ALL),
slide AS (SELECT range AS slot FROM range({LAST_HOUR_DAY_MS[0] // LAST_HOUR_SLOT_MS}, {LAST_HOUR_DAY_MS[1] // LAST_HOUR_SLOT_MS})),
seen AS (SELECT s.slot, ads_id, hm, CAST(sum(n) AS BIGINT) AS cnt FROM slide s
         JOIN pane p ON p.slot > s.slot - {LAST_HOUR_SPAN_MS // LAST_HOUR_SLOT_MS} AND p.slot <= s.slot GROUP BY ALL)
""") + """
SELECT slot, ads_id, '[' || string_agg('{"' || hm || '":' || cnt || '}', ',' ORDER BY hm) || ']' AS minutes_json
FROM seen GROUP BY slot, ads_id
"""

# ---------------------------------------------------------------- rejects, key/field rows
ADS_REJECTS = _with("""
spoilt AS (
  SELECT ts % 11 AS n, CAST(ts AS VARCHAR) AS t, area, concat_ws(',', area, city, user_id, ads_id) AS tail FROM ads_log)
""") + """
SELECT CASE n WHEN 0 THEN t || ',' || area WHEN 1 THEN 'x' || t || ',' || tail
              WHEN 2 THEN t || '000000000000,' || tail WHEN 3 THEN t || '000,' || tail ELSE ',' || tail END AS line,
       CASE n WHEN 0 THEN 'too few fields' ELSE 'bad timestamp' END AS error
FROM spoilt WHERE n <= 4
"""
DAY_AREA_CITY_ADS_HASH = _with(_ADS) + """
SELECT 'area:city:ads:' || day AS key, area || ':' || city || ':' || ads_id AS field, CAST(cnt AS VARCHAR) AS value
FROM dac
"""
DAY_AREA_ADS_TOP3_HASH = f"""
SELECT 'area:ads:top3:' || day AS key, area AS field, ads_json AS value FROM ({DAY_AREA_ADS_TOP3_JSON})
"""
LAST_HOUR_HASH = f"""
SELECT 'last:hour:ads' AS key, ads_id AS field, minutes_json AS value FROM ({LAST_HOUR_JSON})
"""

ORACLE: dict[str, str] = {
    "condition_filter": CONDITION_FILTER,
    "action_classify": ACTION_CLASSIFY,
    "explode_ids": EXPLODE_IDS,
    "category_counts": CATEGORY_COUNTS,
    "category_top10": CATEGORY_TOP10,
    "category_session_counts": CATEGORY_SESSION_COUNTS,
    "category_session_top10": CATEGORY_SESSION_TOP10,
    "page_denominator": PAGE_DENOMINATOR,
    "page_transitions": PAGE_TRANSITIONS,
    "page_conversion": PAGE_CONVERSION,
    "area_product_clicks": AREA_PRODUCT_CITY_COUNTS,
    "city_remark": CITY_REMARK,
    "area_product_top3": AREA_PRODUCT_TOP3,
    "area_product_top3_sql": AREA_PRODUCT_TOP3,
    "ads_parse": ADS_PARSE,
    "user_ad_day_counts": USER_AD_DAY_COUNTS,
    "blacklist_users": BLACKLIST_USERS,
    "blacklist_replay": BLACKLIST_REPLAY,
    "day_area_city_ads": DAY_AREA_CITY_ADS,
    "day_area_ads": DAY_AREA_ADS,
    "day_area_ads_top3": DAY_AREA_ADS_TOP3,
    "day_area_ads_top3_json": DAY_AREA_ADS_TOP3_JSON,
    "last_hour_minutes": LAST_HOUR_MINUTES,
    "last_hour_json": LAST_HOUR_JSON,
    # stream replays end in the same tables as the batch forms
    "stream_blacklist": BLACKLIST_USERS,
    "stream_blacklist_replay": BLACKLIST_REPLAY,
    "stream_blacklist_state": BLACKLIST_USERS,
    "stream_blacklist_counters_state": USER_AD_DAY_COUNTS,
    "stream_day_area_city_ads": DAY_AREA_CITY_ADS,
    "stream_day_area_city_ads_unordered": DAY_AREA_CITY_ADS,
    "stream_day_area_ads_top3": DAY_AREA_ADS_TOP3,
    "stream_last_hour": LAST_HOUR_JSON,
    "ads_rejects": ADS_REJECTS,
    "day_area_city_ads_hash": DAY_AREA_CITY_ADS_HASH,
    "day_area_ads_top3_hash": DAY_AREA_ADS_TOP3_HASH,
    "last_hour_hash": LAST_HOUR_HASH,
    "condition_from_properties": CONDITION_FILTER,
    "area_product_clicks_sql": CITY_REMARK,
    "condition_filter_bucketed": CONDITION_FILTER,
    "blacklist_replay_bloom": BLACKLIST_REPLAY,
    "last_hour_all_slides": LAST_HOUR_ALL_SLIDES,
    # whatever the order in which the clicks came
    "stream_blacklist_unordered": BLACKLIST_USERS,
    "stream_blacklist_replay_unordered": BLACKLIST_REPLAY,
    "stream_running_counts": DAY_AREA_CITY_ADS,
}
