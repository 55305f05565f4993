"""DuckDB side of the views, and pieces of SQL that several checks share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import ROUND_HALF_UP, Decimal

from catalog import views as W
from tidemark.functions import fixed_values as V

START = W.START_MS
DAY, HOUR = 86_400_000, 3_600_000


def pick(values: Sequence[str | None], index: str) -> str:
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"list_extract([{items}], CAST({index} AS INTEGER) + 1)"


def order_time(key: str) -> str:
    return f"({START} + {key} % 30 * {DAY} + {key} % 24 * {HOUR})::BIGINT"


def detail_time(key: str, line: str) -> str:
    return f"({START} + {key} % 30 * {DAY} + ({key} % 24 + {line} - 3) * {HOUR})::BIGINT"


SLOT = """CASE
  WHEN hour(make_timestamp(create_time * 1000) + INTERVAL 8 HOUR) < 6 THEN '凌晨'
  WHEN hour(make_timestamp(create_time * 1000) + INTERVAL 8 HOUR) < 9 THEN '早晨'
  WHEN hour(make_timestamp(create_time * 1000) + INTERVAL 8 HOUR) < 12 THEN '上午'
  WHEN hour(make_timestamp(create_time * 1000) + INTERVAL 8 HOUR) < 14 THEN '中午'
  WHEN hour(make_timestamp(create_time * 1000) + INTERVAL 8 HOUR) < 18 THEN '下午'
  WHEN hour(make_timestamp(create_time * 1000) + INTERVAL 8 HOUR) < 22 THEN '晚上'
  ELSE '夜间' END"""

VIEWS = {
    "order_raw": f"""
        SELECT o_orderkey AS k, {pick(W.OPS, 'o_orderkey % 10')} AS op, o_orderkey::VARCHAR AS id,
               o_custkey::VARCHAR AS uid, o_orderpriority AS consignee, {order_time('o_orderkey')} AS ts_ms,
               {order_time('o_orderkey')} AS create_time, (o_totalprice / 100)::VARCHAR AS total_amount,
               (o_custkey % 34)::BIGINT AS province_id
        FROM orders""",
    "order_info": f"SELECT *, {SLOT} AS pay_time_slot FROM order_raw",
    "detail_raw": f"""
        SELECT l_orderkey AS k, {pick(W.OPS, 'l_orderkey % 10')} AS op,
               (l_orderkey * 10 + l_linenumber)::VARCHAR AS detail_id, l_orderkey::VARCHAR AS order_id,
               l_partkey::BIGINT AS sku_id, 'sku ' || l_partkey AS sku_name, l_quantity::BIGINT AS sku_num,
               l_extendedprice::VARCHAR AS order_price, {detail_time('l_orderkey', 'l_linenumber')} AS ts_ms,
               l_discount::VARCHAR AS split_coupon_amount, l_tax AS split_activity_amount,
               l_extendedprice AS split_total_amount
        FROM lineitem""",
    "users": f"""
        SELECT c_custkey::VARCHAR AS uid, c_name AS uname, c_mktsegment AS user_level, lower(c_name) AS login_name,
               'phone-' || c_custkey AS phone_num, lower(c_name) || '@example.com' AS email,
               coalesce({pick(('M', 'F', None), 'c_custkey % 3')}, 'home') AS gender,
               (DATE '1950-01-01' + (c_custkey * 97 % 20000)::INTEGER) AS born,
               ({START} + c_custkey % 28 * {DAY})::BIGINT AS ts_ms
        FROM customer""",
    "sup": f"""
        SELECT c_custkey::VARCHAR AS uid, (c_custkey % 50 + 150)::VARCHAR AS height, 'cm' AS unit_height,
               (floor(abs(c_acctbal))::BIGINT % 60 + 45)::VARCHAR AS weight, 'kg' AS unit_weight,
               ({START} + c_custkey % 28 * {DAY} + (c_custkey % 13 - 6) * {DAY}
                + CASE WHEN c_custkey % 13 = 11 THEN c_custkey % 2 ELSE 0 END)::BIGINT AS ts_ms
        FROM customer""",
    "page_log": f"""
        SELECT event_id, user_id::VARCHAR AS uid, epoch_us(ts) // 1000 AS ts,
               {pick(('Android', 'iOS', 'Windows'), 'event_id % 3')} AS os, event_type AS ch,
               'model-' || event_id % 5 AS md, {pick(('xiaomi', 'vivo', 'Redmi', None), 'event_id % 4')} AS ba,
               'area-' || user_id % 34 AS ar, 'v2.1' AS vc,
               CASE WHEN event_type = 'view' THEN
                 {pick((*W.CATEGORY_OF_TYPE, 'NONE'), "(props->>'k')::INTEGER % 7")} END AS search_item
        FROM events""",
    "sku": f"""
        SELECT p_partkey AS sku_id, p_type AS c3id, {pick(W.BRANDS, 'p_partkey % 6')} AS tname,
               CASE p_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in W.CATEGORY_OF_TYPE.items())} END AS b1_name
        FROM part""",
    "keyword": f"""
        SELECT b.search_item, b.b1_category, c.search_category AS "searchCategory"
        FROM (SELECT p_type AS search_item, arg_max({pick(W.FIRST_CATEGORIES, 'p_partkey % 7')}, p_partkey) AS b1_category
              FROM part GROUP BY p_type) b
        LEFT JOIN (SELECT {pick(W.FIRST_CATEGORIES, 's_suppkey % 7')} AS category_name,
                          arg_min({pick(W.SEARCH_CATEGORIES, '(s_suppkey % 7 + s_suppkey // 7) % 7')}, s_suppkey) AS search_category
                   FROM supplier GROUP BY 1) c ON b.b1_category = c.category_name""",
    "page_unique": """
        SELECT uid, ts, os, ch, md, ba, ar, vc, search_item FROM (SELECT DISTINCT uid, ts, os, ch, md, ba, ar, vc, search_item
        FROM page_log) WHERE uid <> ''""",
    "snapshot": """
        SELECT uid, window_start, pv, os, ch, md, ba, search_item, ts FROM (
          SELECT *, row_number() OVER (PARTITION BY uid, window_start ORDER BY ts DESC, pv DESC) AS rn FROM (
            SELECT uid, ts, ts // 120000 * 120000 AS window_start,
                   count(*) OVER w AS pv,
                   array_to_string(list_sort(list_distinct(array_agg(os) OVER w)), ',') AS os,
                   array_to_string(list_sort(list_distinct(array_agg(ch) OVER w)), ',') AS ch,
                   array_to_string(list_sort(list_distinct(array_agg(md) OVER w)), ',') AS md,
                   array_to_string(list_sort(list_distinct(array_agg(coalesce(ba, 'null')) OVER w)), ',') AS ba,
                   coalesce(array_to_string(list_sort(list_distinct(array_agg(search_item) FILTER (search_item IS NOT NULL) OVER w)), ','), '') AS search_item
            FROM page_unique
            WINDOW w AS (PARTITION BY uid ORDER BY ts, os, ch, md, ba ROWS UNBOUNDED PRECEDING)))
        WHERE rn = 1""",
}

DEPENDS = {"order_info": ["order_raw"], "page_unique": ["page_log"], "snapshot": ["page_log", "page_unique"]}


def score(prefix: str, rules: Mapping[str, Sequence[float]], coefficient: float, value: str,
          other: Sequence[float] | None = None, otherwise: str = "NULL::DOUBLE") -> str:
    """Six score columns as CASE expressions over the value."""
    columns = []
    for i, bucket in enumerate(V.BUCKETS):
        cases = " ".join(f"WHEN '{name}' THEN {product(w[i], coefficient)}" for name, w in rules.items())
        rest = otherwise
        if other is not None:
            rest = f"CASE WHEN {value} <> '' THEN {product(other[i], coefficient)} END"
        columns.append(f'CASE {value} {cases} ELSE {rest} END AS "{prefix}_{bucket}"')
    return ", ".join(columns)


def tiers(prefix: str, value: str, low: str, middle: str) -> str:
    columns = []
    for i, bucket in enumerate(V.BUCKETS):
        a, b, c = (product(v[i], 0.15) for v in (V.AMOUNT_LOW, V.AMOUNT_MIDDLE, V.AMOUNT_OTHER))
        columns.append(f'CASE WHEN {low} THEN {a} WHEN {middle} THEN {b} ELSE {c} END AS "{prefix}_{bucket}"')
    return ", ".join(c.replace("{v}", value) for c in columns)


def product(weight: float, coefficient: float) -> str:
    exact = Decimal(str(weight)) * Decimal(str(coefficient))
    return f"{exact.quantize(Decimal('0.001'), ROUND_HALF_UP)}::DOUBLE"


def amount_score(value: str) -> str:
    return tiers("amount", value, "{v} < 1000", "{v} > 1000 AND {v} < 4000")


def columns(prefix: str) -> str:
    return ", ".join(f'"{prefix}_{b}"' for b in V.BUCKETS)


DEVICE = score("device", V.DEVICE_WEIGHTS, 0.1, "judge_os")
SEARCH = score("search", V.SEARCH_WEIGHTS, 0.15, '"searchCategory"', otherwise="0::DOUBLE")
PAY_TIME = score("pay_time", V.PAY_TIME_WEIGHTS, 0.1, "pay_time_slot")
AMOUNT = amount_score("total_amount::DOUBLE")
BRAND = score("tname", V.BRAND_WEIGHTS, 0.2, "tname", V.BRAND_OTHER)
CATEGORY = score("b1name", V.CATEGORY_WEIGHTS, 0.3, "b1_name", V.CATEGORY_OTHER)

JUDGE = """CASE WHEN list_contains(string_split(os, ','), 'iOS') THEN 'iOS'
  WHEN list_contains(string_split(os, ','), 'Android') THEN 'Android' ELSE string_split(os, ',')[1] END"""

VIEWS["base2"] = f"""
    SELECT *, {DEVICE}, {SEARCH} FROM (
      SELECT s.*, k.b1_category, k."searchCategory", {JUDGE} AS judge_os
      FROM snapshot s LEFT JOIN keyword k ON s.search_item = k.search_item)"""
DEPENDS["base2"] = ["page_log", "page_unique", "snapshot", "keyword"]

VIEWS["lines"] = f"""
    SELECT o.*, d.detail_id, d.order_id, d.sku_id, d.sku_num, d.sku_name, d.order_price, d.split_coupon_amount,
           d.split_activity_amount, d.split_total_amount
    FROM order_info o JOIN detail_raw d ON o.id = d.order_id
     AND d.ts_ms BETWEEN o.ts_ms - {2 * HOUR} AND o.ts_ms + {2 * HOUR} WHERE o.op <> 'd' AND d.op <> 'd'"""
DEPENDS["lines"] = ["order_raw", "order_info", "detail_raw"]

VIEWS["fresh"] = """
    SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY detail_id, ts_ms ORDER BY
      sku_id, order_price, sku_num, split_total_amount, split_coupon_amount, split_activity_amount, sku_name) AS rn
      FROM lines) WHERE rn = 1"""
DEPENDS["fresh"] = [*DEPENDS["lines"], "lines"]

VIEWS["base4"] = f"""
    SELECT *, {PAY_TIME}, {AMOUNT}, {BRAND}, {CATEGORY} FROM (
      SELECT f.*, s.c3id, s.tname, s.b1_name FROM fresh f LEFT JOIN sku s ON f.sku_id = s.sku_id WHERE f.op <> 'd')"""
DEPENDS["base4"] = [*DEPENDS["fresh"], "fresh", "sku"]

AS_OF = "DATE '2025-05-12'"
ZODIAC = "CASE " + " ".join(
    f"WHEN month(born) * 100 + day(born) <= {last} THEN '{name}'" for last, name in V.ZODIAC
) + f" ELSE '{V.LAST_ZODIAC}' END"
VIEWS["profile"] = f"""
    SELECT uid, uname, user_level, login_name, phone_num, email, gender, born::VARCHAR AS birthday, ts_ms,
           (year(born) // 10 * 10)::INTEGER AS decade,
           (year({AS_OF}) - year(born) - CASE WHEN strftime({AS_OF}, '%m%d') < strftime(born, '%m%d')
             THEN 1 ELSE 0 END)::INTEGER AS age, {ZODIAC} AS zodiac_sign
    FROM users"""
DEPENDS["profile"] = ["users"]


def base6(days: int) -> str:
    return f"""
    SELECT p.*, s.height, s.unit_height, s.weight, s.unit_weight FROM profile p JOIN sup s
      ON p.uid = s.uid AND s.ts_ms BETWEEN p.ts_ms - {days * DAY} AND p.ts_ms + {days * DAY}"""


VIEWS["base6"] = base6(5)
DEPENDS["base6"] = ["users", "profile", "sup"]
VIEWS["base6_day"] = base6(1)
DEPENDS["base6_day"] = ["users", "profile", "sup"]

TOTALS = "[" + ", ".join(
    " + ".join(f'coalesce("{p}_{b}", 0)' for p in ("search", "device", "pay_time", "b1name", "tname", "amount"))
    for b in V.BUCKETS
) + "]"
NAMES = "[" + ", ".join(f"'{b}'" for b in V.BUCKETS) + "]"
AGE_LEVEL = f"list_extract({NAMES}, list_position({TOTALS}, list_max({TOTALS})))"

VIEWS["sku_names"] = f"""
    SELECT p_partkey AS sku_id, bcname, btname FROM part
    LEFT JOIN (SELECT n_nationkey, {pick(W.SEARCH_CATEGORIES, 'n_nationkey % 7')} AS bcname,
                      {pick(W.ORDER_NAMES, 'n_nationkey % 5')} AS btname FROM nation)
      ON p_size % 28 = n_nationkey"""

VIEWS["order_sku"] = f"""
    SELECT o.op, o.id AS order_id, o.create_time, o.total_amount, o.uid, o.ts_ms, d.sku_id::VARCHAR AS sku_id
    FROM order_raw o JOIN detail_raw d ON o.id = d.order_id
     AND d.ts_ms BETWEEN o.ts_ms - {30 * DAY} AND o.ts_ms + {30 * DAY} WHERE o.op <> 'd' AND d.op <> 'd'"""
DEPENDS["order_sku"] = ["order_raw", "detail_raw"]

ORDER_PRICE = tiers("price", "total_amount::DOUBLE", "{v} >= 0 AND {v} <= 1000", "{v} > 1000 AND {v} <= 4000")
ORDER_BRAND = score("brand", V.ORDER_BRAND_WEIGHTS, 0.2, "btname", V.ORDER_BRAND_OTHER)
ORDER_CATEGORY = score("category", V.SEARCH_WEIGHTS, 0.3, "bcname", otherwise="0::DOUBLE")
SUMS = ", ".join(
    f'coalesce("brand_{b}", 0) + coalesce("category_{b}", 0) + coalesce("price_{b}", 0) AS "sum_{b}"' for b in V.BUCKETS
)
VIEWS["order_fresh"] = """
    SELECT order_id, ts_ms, any_value(uid) AS uid, any_value(op) AS op, any_value(create_time) AS create_time,
           any_value(total_amount) AS total_amount, min(sku_id) AS sku_id
    FROM order_sku WHERE op <> 'd' GROUP BY order_id, ts_ms"""
DEPENDS["order_fresh"] = [*DEPENDS["order_sku"], "order_sku"]
VIEWS["order_sum"] = f"""
    SELECT order_id, uid, ts_ms, sku_id, btname, bcname, {SUMS} FROM (
      SELECT *, {ORDER_PRICE}, {ORDER_BRAND}, {ORDER_CATEGORY} FROM (
        SELECT f.*, coalesce(v.btname, n.btname) AS btname, coalesce(v.bcname, n.bcname) AS bcname
        FROM order_fresh f
        LEFT JOIN sku_names n ON f.sku_id = n.sku_id::VARCHAR
        LEFT JOIN (SELECT o_orderkey::VARCHAR AS order_id, {pick(W.SEARCH_CATEGORIES, 'o_custkey % 7')} AS bcname,
                          {pick(W.ORDER_NAMES, 'o_custkey % 5')} AS btname
                   FROM orders WHERE o_orderstatus = 'P') v ON f.order_id = v.order_id))"""
DEPENDS["order_sum"] = [*DEPENDS["order_fresh"], "order_fresh", "sku_names"]


def with_views(query: str, *names: str) -> str:
    """``query`` with the CTEs it needs."""
    wanted = {d for n in names for d in (*DEPENDS.get(n, []), n)}
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in wanted)
    return f"WITH {ctes} {query}" if ctes else query
