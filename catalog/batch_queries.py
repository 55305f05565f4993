"""Batch queries: one per operator, and the feeds built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.registry import query
from catalog.views import START_MS, Views, order_time, pick
from tidemark import schemas, session
from tidemark.functions import dates, numbers, text
from tidemark.functions.dates import DAY_MS, HOUR_MS, MINUTE_MS
from tidemark.operators import (
    cdc, dedup, dimensions, feed_joins, history, joins, projections, running, scoring, sketch,
)
from tidemark.plans import flows, jobs

AS_OF = "2025-05-12"


def as_number(name: str):
    return F.col(name).cast("double").alias(name)


# --- Change feed -----------------------------------------------------------------------------------------

LIVE_TEXT = """
    SELECT 'order_info' AS table_name, op, ts_ms, id, total_amount::DOUBLE AS amount FROM order_raw WHERE k % 97 <> 0
    UNION ALL
    SELECT 'order_detail', op, ts_ms, detail_id, order_price::DOUBLE FROM detail_raw WHERE detail_id::BIGINT % 97 <> 0"""


@query(f"SELECT table_name, op, ts_ms, id, amount, op = 'd' AS was_deleted, 'shop' AS db FROM ({LIVE_TEXT})",
       "order_raw", "detail_raw")
def cdc_parse_envelope(v: Views):
    row = F.coalesce("after", "before")
    fields = F.from_json(row, "id STRING, total_amount STRING, order_price STRING")
    return cdc.parse_envelope(v.change_feed()).withColumn("_r", fields).select(
        F.col("source.table").alias("table_name"), "op", "ts_ms", F.col("_r.id").alias("id"),
        F.coalesce("_r.total_amount", "_r.order_price").cast("double").alias("amount"),
        F.col("after").isNull().alias("was_deleted"), F.col("source.db").alias("db"),
    )


@query("""SELECT op, id AS order_id, create_time, total_amount::DOUBLE AS total_amount, uid, ts_ms
          FROM order_raw WHERE op <> 'd' AND k % 97 <> 0""", "order_raw")
def cdc_demux_order_info(v: Views):
    changes = cdc.table(cdc.parse_envelope(v.change_feed()), "order_info")
    return projections.order_change(changes).withColumn("total_amount", as_number("total_amount"))


@query("""SELECT op, order_id, ts_ms, sku_id::VARCHAR AS sku_id
          FROM detail_raw WHERE op <> 'd' AND detail_id::BIGINT % 97 <> 0""", "detail_raw")
def cdc_demux_order_detail(v: Views):
    return projections.order_detail_change(cdc.table(cdc.parse_envelope(v.change_feed()), "order_detail"))


@query("""SELECT id || '_' || ts_ms AS id, op, CASE WHEN k % 11 <> 0 THEN 'shop' END AS "database",
                 CASE WHEN k % 11 <> 0 THEN 'order_info' END AS "tableName", ts_ms::VARCHAR AS ts, uid
          FROM order_raw""", "order_raw")
def cdc_flatten_key_ts(v: Views):
    rows = v.order_changes().select(
        F.col("after.id").alias("key"),
        F.when(F.col("after.id").cast("bigint") % 11 == 0, "heartbeat.shop").otherwise("mysql.shop.order_info").alias("topic"),
        "op", "ts_ms", F.lit(None).cast("string").alias("before"), F.to_json("after").alias("after"),
    )
    return cdc.flatten(rows).select(
        "id", "op", "database", "tableName", "ts", F.get_json_object("after", "$.user_id").alias("uid")
    )


ROUTES = [
    ("order_info", "dwd_orders", "id,total_amount", "info", "id", "r"),
    ("user_info", "dwd_users", "id", "info", "id", "r"),
]


@query("""SELECT 'dwd_orders' AS sink_table, op, ts_ms, id, total_amount::DOUBLE AS total_amount,
                 NULL::VARCHAR AS user_id, 2 AS fields FROM order_raw WHERE k % 97 <> 0""", "order_raw")
def cdc_route_columns(v: Views):
    routes = v.spark.createDataFrame(ROUTES, schemas.DIM_ROUTE)
    routed = cdc.route(cdc.parse_envelope(v.change_feed()), routes)
    return routed.select(
        "sink_table", "op", "ts_ms",
        F.get_json_object("value", "$.id").alias("id"),
        F.get_json_object("value", "$.total_amount").cast("double").alias("total_amount"),
        F.get_json_object("value", "$.user_id").alias("user_id"),
        F.size(F.json_object_keys("value")).alias("fields"),
    )


@query("""
    WITH changes AS (
      SELECT o_custkey AS id, o_orderkey AS seq, CASE WHEN o_orderkey % 10 = 0 THEN 'd' ELSE 'u' END AS op,
             CASE WHEN o_orderkey % 3 <> 0 THEN 'name ' || o_orderkey END AS name,
             CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS segment FROM orders),
    everything AS (
      SELECT id, seq, op, name, segment FROM changes
      UNION ALL SELECT c_custkey, -1, 'r', c_name, c_mktsegment FROM customer),
    alive AS (
      SELECT e.* FROM everything e LEFT JOIN (SELECT id, max(seq) AS gone FROM changes WHERE op = 'd' GROUP BY id) g
        ON e.id = g.id WHERE e.op <> 'd' AND (g.gone IS NULL OR e.seq > g.gone))
    SELECT id, arg_max(name, seq) FILTER (name IS NOT NULL) AS name,
           arg_max(segment, seq) FILTER (segment IS NOT NULL) AS segment FROM alive GROUP BY id""")
def cdc_apply_snapshot(v: Views):
    snapshot = v.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    key = F.col("o_orderkey")
    changes = v.table("orders").select(
        F.col("o_custkey").alias("id"), key.alias("seq"),
        F.when(key % 10 == 0, "d").otherwise("u").alias("op"),
        F.when(key % 3 != 0, F.concat(F.lit("name "), key)).alias("name"),
        F.when(key % 4 != 0, F.col("o_orderpriority")).alias("segment"),
    )
    return cdc.apply_changes(snapshot, changes, "id", ["name", "segment"], ["seq"])


@query(f"""
    SELECT 'user_info' AS table_name, 'r' AS op, {START_MS}::BIGINT AS ts_ms, c_custkey::VARCHAR AS id, c_name AS name
    FROM customer
    UNION ALL
    SELECT 'user_info', op, ts_ms, uid, consignee FROM order_raw WHERE op <> 'd'""", "order_raw")
def cdc_snapshot_bootstrap(v: Views):
    rows = v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    changes = v.order_changes().filter(F.col("op") != "d").select(
        F.lit(None).cast("string").alias("before"),
        F.to_json(F.struct(F.col("after.user_id").alias("id"), F.col("after.consignee").alias("name"))).alias("after"),
        F.struct(F.lit("shop").alias("db"), F.lit("user_info").alias("table"), "ts_ms").alias("source"),
        "op", "ts_ms",
    )
    feed = cdc.bootstrap(rows, "shop", "user_info", F.lit(START_MS)).unionByName(changes)
    return cdc.table(feed, "user_info").select(
        F.col("source.table").alias("table_name"), "op", "ts_ms",
        F.col("after.id").alias("id"), F.col("after.name").alias("name"),
    )


@query("""SELECT uid, seq, name, op FROM (
            SELECT o_custkey AS uid, o_orderkey AS seq, o_orderpriority AS name,
                   CASE WHEN o_orderkey % 10 = 0 THEN 'd' ELSE 'u' END AS op,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
          WHERE rn = 1 AND op <> 'd'""")
def upsert_latest_per_key(v: Views):
    changes = v.table("orders").select(
        F.col("o_custkey").alias("uid"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_orderkey") % 10 == 0, "d").otherwise("u").alias("op"),
    )
    return cdc.latest_per_key(changes, "uid", ["seq"])


@query("""SELECT 'base4' AS source, id, uid FROM order_raw
          UNION ALL SELECT 'base6', uid, uid FROM users
          UNION ALL SELECT 'base2', event_id::VARCHAR, uid FROM page_log""", "order_raw", "users", "page_log")
def label_feeds_union(v: Views):
    as_text = lambda df: df.select(F.to_json(F.struct("id", "uid")).alias("value"))
    merged = cdc.union_feeds(
        base2=as_text(v.page_logs().select(F.col("common.sid").alias("id"), F.col("common.uid").alias("uid"))),
        base4=as_text(v.order_changes().select("after.id", F.col("after.user_id").alias("uid"))),
        base6=as_text(v.user_changes().select("after.id", F.col("after.id").alias("uid"))),
    )
    return merged.select(
        "source",
        F.get_json_object("value", "$.id").alias("id"),
        F.get_json_object("value", "$.uid").alias("uid"),
    )


# --- Page logs -------------------------------------------------------------------------------------------

PAGE = ["uid", "ts", "os", "ch", "md", "ba", "ar", "vc", "search_item"]


def flat_page(df, *extra):
    device = [F.col(f"deviceInfo.{c}").alias(c) for c in ("os", "ch", "md", "ba", "ar", "vc")]
    return df.select("uid", "ts", *device, "search_item", *extra)


@query("SELECT uid, ts, os, ch, md, ba, ar, vc, search_item FROM page_log", "page_log")
def page_log_project(v: Views):
    return flat_page(projections.with_uid(projections.page(cdc.parse_page_log(v.page_feed_text()))))


@query("SELECT DISTINCT uid, ts, os, ch, md, ba, ar, vc, search_item FROM page_log", "page_log")
def page_log_dedup_full_row(v: Views):
    """All page logs, a third of them twice."""
    logs = v.page_logs()
    pages = projections.with_uid(projections.page(logs.unionByName(logs.filter(F.col("event_id") % 3 == 0))))
    return flat_page(dedup.full_row(pages))


RUNNING = """
    SELECT event_id, uid, count(*) OVER w AS pv,
           array_to_string(list_sort(list_distinct(array_agg(os) OVER w)), ',') AS os,
           array_to_string(list_sort(list_distinct(array_agg(ch) OVER w)), ',') AS ch,
           array_to_string(list_sort(list_distinct(array_agg(md) OVER w)), ',') AS md,
           array_to_string(list_sort(list_distinct(array_agg(coalesce(ba, 'null')) OVER w)), ',') AS ba,
           coalesce(array_to_string(list_sort(list_distinct(
             array_agg(search_item) FILTER (search_item IS NOT NULL) OVER w)), ','), '') AS search_item, ts
    FROM page_log WINDOW w AS (PARTITION BY uid ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


@query(RUNNING, "page_log")
def page_running_pv_sets(v: Views):
    return running.page_statistics(projections.with_uid(projections.page(v.page_logs(), "event_id")), ["event_id"])


@query("SELECT * FROM snapshot", "snapshot")
def page_window_last_snapshot(v: Views):
    pages = projections.with_uid(projections.page(v.page_logs()))
    return running.page_window_snapshots(dedup.full_row(pages), 2 * MINUTE_MS, hot_from=pages)


@query(f"""SELECT uid, window_start, ts, event_id, ch FROM (
             SELECT uid, ts // {HOUR_MS} * {HOUR_MS} AS window_start, ts, event_id, ch,
                    row_number() OVER (PARTITION BY uid, ts // {HOUR_MS} ORDER BY ts DESC, event_id DESC) AS rn
             FROM page_log) WHERE rn = 1""", "page_log")
def page_last_per_window(v: Views):
    pages = v.page_logs().select(
        F.col("common.uid").alias("uid"), "ts", "event_id", F.col("common.ch").alias("ch")
    )
    return running.last_per_window(pages, "uid", "ts", HOUR_MS, ["event_id"])


@query("""
    SELECT user_id, op, array_to_string(list_sort(list_distinct(array_agg(ts_ms::VARCHAR) OVER w)), ',') AS ts_ms,
           array_to_string(list_sort(list_distinct(array_agg(create_time::VARCHAR) OVER w)), ',') AS create_time,
           array_to_string(list_sort(list_distinct(array_agg(id) OVER w)), ',') AS id,
           len(list_distinct(array_agg(total_amount) OVER w)) AS amounts,
           coalesce(array_to_string(list_sort(list_distinct(array_agg(item) FILTER (item IS NOT NULL) OVER w)), ','), '') AS search_item
    FROM (SELECT *, uid AS user_id, CASE WHEN k % 3 = 0 THEN consignee END AS item FROM order_raw)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, id ROWS UNBOUNDED PRECEDING)""", "order_raw")
def order_running_sets(v: Views):
    orders = v.order_changes().select(
        F.col("after.user_id").alias("user_id"), "op", "ts_ms", F.col("after.total_amount").alias("total_amount"),
        F.col("after.create_time").alias("create_time"), F.col("after.id").alias("id"),
        F.when(F.col("after.id").cast("bigint") % 3 == 0, F.col("after.consignee")).alias("search_item"),
    ).withColumn("tie", F.col("id"))
    done = running.order_statistics(orders, "ts_ms", ["tie"])
    return done.withColumn("total_amount", F.size(F.split("total_amount", ",")).cast("bigint")).withColumnRenamed(
        "total_amount", "amounts"
    )


@query("""
    SELECT id, user_id, ts_ms, len(list_distinct(array_agg(create_time) OVER w)) AS create_time_count,
           len(list_distinct(array_agg(total_amount) OVER w)) AS total_amount_count,
           len(list_distinct(coalesce(array_agg(item) FILTER (item IS NOT NULL) OVER w, []))) AS item_count,
           row_number() OVER (PARTITION BY user_id, total_amount ORDER BY ts_ms, id) = 1 AS total_amount_new,
           row_number() OVER (PARTITION BY user_id, create_time ORDER BY ts_ms, id) = 1 AS create_time_new,
           item IS NOT NULL AND row_number() OVER (PARTITION BY user_id, item ORDER BY ts_ms, id) = 1 AS item_new
    FROM (SELECT *, uid AS user_id, CASE WHEN k % 3 = 0 THEN consignee END AS item FROM order_raw)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, id ROWS UNBOUNDED PRECEDING)""", "order_raw")
def order_running_counts(v: Views):
    """How many different values each user's orders have had, and which are new: linear in the rows."""
    orders = v.order_changes("id", "user_id", "create_time", "total_amount", "consignee").select(
        "after.user_id", "ts_ms", "after.id", "after.create_time", "after.total_amount",
        F.when(F.col("after.id").cast("bigint") % 3 == 0, F.col("after.consignee")).alias("item"),
    )
    return running.with_distinct_counts(orders, "user_id", "ts_ms", ["id"], ["create_time", "total_amount", "item"]).drop(
        "create_time", "total_amount", "item"
    )


# --- Page scores -----------------------------------------------------------------------------------------


def keywords(v: Views):
    return dimensions.keyword_categories(v.name_categories(), v.comparison())


@query(f"SELECT event_id, judge_os, {S.DEVICE} FROM (SELECT event_id, os AS judge_os FROM page_log)", "page_log")
def device_score(v: Views):
    pages = projections.page(v.page_logs(), "event_id").select(
        "event_id", scoring.judged_os(F.col("deviceInfo.os")).alias("judge_os")
    )
    return scoring.add_scores(pages, {"device": scoring.device_vector(F.col("judge_os"))})


@query(f"""SELECT event_id, {S.SEARCH} FROM (SELECT event_id, k."searchCategory" FROM page_log p
           LEFT JOIN keyword k ON p.search_item = k.search_item)""", "page_log", "keyword")
def search_score(v: Views):
    pages = projections.page(v.page_logs(), "event_id").select("event_id", "search_item")
    found = dimensions.add_search_category(pages, keywords(v))
    return scoring.add_scores(
        found.select("event_id", "searchCategory"), {"search": scoring.search_vector(F.col("searchCategory"))}
    ).drop("searchCategory")


@query("""SELECT event_id, p.search_item, k.b1_category, k."searchCategory" FROM page_log p
          LEFT JOIN keyword k ON p.search_item = k.search_item""", "page_log", "keyword")
def keyword_category_lookup(v: Views):
    pages = projections.page(v.page_logs(), "event_id").select("event_id", "search_item")
    return dimensions.add_search_category(pages, keywords(v))


@query("SELECT * EXCLUDE window_start, ts AS ts_ms FROM base2", "base2")
def base2_feed(v: Views):
    return flows.page_feed(v.page_logs(), keywords(v))


# --- Orders ----------------------------------------------------------------------------------------------


@query("""SELECT id, uid, consignee, create_time, total_amount::DOUBLE AS original_total_amount,
                 total_amount::DOUBLE AS total_amount, province_id, pay_time_slot, ts_ms FROM order_info""", "order_info")
def order_project_time_slot(v: Views):
    orders = projections.with_id(projections.order(v.order_changes()))
    return orders.withColumn("total_amount", as_number("total_amount")).withColumn(
        "original_total_amount", as_number("original_total_amount")
    )


@query("""SELECT detail_id AS id, order_id, sku_id, sku_name, sku_num, order_price::DOUBLE AS order_price, ts_ms,
                 ts_ms AS create_time, split_coupon_amount::DOUBLE AS split_coupon_amount,
                 split_activity_amount::DOUBLE AS split_activity_amount,
                 split_total_amount::DOUBLE AS split_total_amount FROM detail_raw""", "detail_raw")
def order_detail_project(v: Views):
    details = projections.with_id(projections.order_detail(v.detail_changes()), "order_id")
    for name in ("order_price", "split_coupon_amount", "split_activity_amount", "split_total_amount"):
        details = details.withColumn(name, as_number(name))
    return details


LINE_COLUMNS = """ts_ms, id, uid, consignee, create_time, total_amount::DOUBLE AS total_amount, province_id,
    pay_time_slot, detail_id, order_id, sku_id, sku_num, sku_name, order_price::DOUBLE AS order_price,
    split_coupon_amount::DOUBLE AS split_coupon_amount, split_activity_amount, split_total_amount"""


def line_columns(df):
    for name in ("total_amount", "order_price", "split_coupon_amount"):
        df = df.withColumn(name, as_number(name))
    return df.drop("original_total_amount")


def narrow_changes(v: Views):
    orders = cdc.live(v.order_changes("id", "create_time", "total_amount", "user_id"))
    return projections.order_change(orders), projections.order_detail_change(cdc.live(v.detail_changes("order_id", "sku_id")))


def order_lines(v: Views):
    orders = projections.with_id(projections.order(cdc.live(v.order_changes())))
    details = projections.with_id(projections.order_detail(cdc.live(v.detail_changes())), "order_id")
    return feed_joins.orders_with_details(orders, details)


@query(f"SELECT {LINE_COLUMNS} FROM lines", "lines")
def order_detail_interval_join_2h(v: Views):
    return line_columns(order_lines(v))


@query("SELECT op, order_id, create_time, total_amount::DOUBLE AS total_amount, uid, ts_ms, sku_id FROM order_sku",
       "order_sku")
def order_detail_interval_join_30d(v: Views):
    orders, details = narrow_changes(v)
    joined = feed_joins.orders_with_sku(orders, details)
    return joined.withColumn("total_amount", as_number("total_amount"))


@query(f"SELECT {LINE_COLUMNS} FROM fresh", "fresh")
def detail_monotone_dedup(v: Views):
    return line_columns(dedup.first_in_event_order(order_lines(v), "detail_id", "ts_ms", flows.DETAIL_TIES))


@query("""
    SELECT uid, event_id, ts_ms FROM (
      SELECT *, max(ts_ms) OVER (PARTITION BY uid ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM (SELECT uid, event_id, ts + event_id * 7919 % 97 * 3600000 AS ts_ms FROM page_log))
    WHERE seen IS NULL OR ts_ms > seen""", "page_log")
def user_monotone_dedup(v: Views):
    pages = v.page_logs().select(
        F.col("common.uid").alias("uid"), "event_id",
        (F.col("ts") + F.col("event_id") * 7919 % 97 * HOUR_MS).alias("ts_ms"),
    )
    return dedup.increasing_only(pages, "uid", "ts_ms", "event_id")


@query("SELECT order_id, ts_ms, uid, sku_id FROM order_fresh", "order_fresh")
def order_bloom_equiv_dedup(v: Views):
    orders, details = narrow_changes(v)
    fresh = dedup.by_key_and_time(feed_joins.orders_with_sku(orders, details), "order_id")
    return fresh.select("order_id", "ts_ms", "uid", "sku_id")


@query("""SELECT order_id, ts_ms, uid, sku_id FROM order_fresh f
          WHERE NOT EXISTS (SELECT 1 FROM order_raw o WHERE o.k % 2 = 0 AND o.id = f.order_id AND o.ts_ms = f.ts_ms)""", "order_fresh", "order_raw")
def order_sketch_dedup(v: Views):
    """Fresh orders without those of which a time is known; most that are not known never leave their task."""
    orders, details = narrow_changes(v)
    known = orders.filter(F.col("order_id").cast("bigint") % 2 == 0).select("order_id", "ts_ms")
    unknown = sketch.unknown(orders, known, ["order_id", "ts_ms"])
    fresh = dedup.by_key_and_time(feed_joins.orders_with_sku(unknown, details), "order_id")
    return fresh.select("order_id", "ts_ms", "uid", "sku_id")


@query(f"""SELECT uid, ts // {DAY_MS} * {DAY_MS} AS ts_ms, min(event_id) AS event_id FROM page_log GROUP BY ALL""",
       "page_log")
def user_bloom_equiv_dedup(v: Views):
    pages = v.page_logs().select(
        F.col("common.uid").alias("uid"), (F.floor(F.col("ts") / DAY_MS) * DAY_MS).cast("bigint").alias("ts_ms"),
        "event_id",
    )
    return dedup.by_key_and_time(pages, "uid")


@query("""SELECT d.detail_id, d.sku_id, d.order_price::DOUBLE AS order_price, s.c3id, s.tname, s.b1_name
          FROM detail_raw d LEFT JOIN sku s ON d.sku_id = s.sku_id""", "detail_raw", "sku")
def sku_enrich_lookup(v: Views):
    lines = v.detail_changes("id", "sku_id", "order_price").select(
        F.col("after.id").alias("detail_id"), "after.sku_id", F.col("after.order_price").cast("double").alias("order_price")
    )
    return dimensions.enrich_by_sku(lines, v.sku_dim(), v.type_categories())


@query("""SELECT c_custkey AS id, c_name AS b3name, n_name AS b2name, r_name AS b1name FROM customer
          JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def category_hierarchy_join(v: Views):
    return dimensions.category_hierarchy(*v.category_levels())


@query("""SELECT p_partkey AS skuid, s_suppkey AS spuid, s_nationkey AS c3id, n_name AS tname FROM part
          JOIN supplier ON p_partkey % 120 = s_suppkey JOIN nation ON s_suppkey % 25 = n_nationkey""")
def sku_spu_trademark_join(v: Views):
    return dimensions.sku_dimension(*v.sku_tables())


@query("""SELECT o.id AS order_id, o.uid, n.bcname, n.btname, d.order_price::DOUBLE AS price, o.create_time
          FROM order_raw o LEFT JOIN detail_raw d ON o.id = d.order_id LEFT JOIN sku_names n ON d.sku_id = n.sku_id""",
       "order_raw", "detail_raw", "sku_names")
def order_category_left_chain(v: Views):
    orders = v.order_changes("id", "user_id", "create_time").select(
        "after.id", F.col("after.user_id").alias("uid"), "after.create_time"
    )
    details = v.detail_changes("order_id", "sku_id", "order_price").select("after.*")
    chain = dimensions.order_categories(orders, details, v.dictionary_skus(), v.dictionary())
    return chain.withColumn("price", as_number("price"))


@query("""SELECT order_id, sku_id, btname, bcname FROM (
            SELECT f.order_id, f.sku_id, coalesce(x.btname, n.btname) AS btname, coalesce(x.bcname, n.bcname) AS bcname
            FROM order_fresh f LEFT JOIN sku_names n ON f.sku_id = n.sku_id::VARCHAR
            LEFT JOIN (SELECT order_id, btname, bcname FROM order_sum
                       WHERE order_id IN (SELECT o_orderkey::VARCHAR FROM orders WHERE o_orderstatus = 'P')) x
              ON f.order_id = x.order_id)""", "order_fresh", "sku_names", "order_sum")
def order_names_lookup(v: Views):
    orders, details = narrow_changes(v)
    fresh = dedup.by_key_and_time(feed_joins.orders_with_sku(orders, details), "order_id")
    names = dimensions.sku_names(v.dictionary_skus(), v.dictionary())
    return dimensions.add_order_names(fresh, names, v.overrides()).select("order_id", "sku_id", "btname", "bcname")


@query(f"SELECT id, {S.PAY_TIME} FROM order_info", "order_info")
def pay_time_score(v: Views):
    orders = v.order_changes("id", "create_time").select(
        "after.id", dates.pay_time_slot(F.col("after.create_time")).alias("slot")
    )
    return scoring.add_scores(orders, {"pay_time": scoring.pay_time_vector(F.col("slot"))}).drop("slot")


@query(f"SELECT id, {S.AMOUNT} FROM order_raw", "order_raw")
def amount_score(v: Views):
    orders = v.order_changes("id", "total_amount").select("after.*")
    return scoring.add_scores(orders, {"amount": scoring.amount_vector(F.col("total_amount"))}).drop("total_amount")


@query(f"SELECT sku_id, {S.BRAND} FROM (SELECT sku_id, tname FROM sku UNION ALL SELECT sku_id, 'late' FROM sku)", "sku")
def brand_score(v: Views):
    skus = v.sku_dim().select(F.col("skuid").alias("sku_id"), "tname")
    return scoring.add_scores(skus, {"tname": scoring.brand_vector(F.col("tname"))}).drop("tname")


@query(f"SELECT sku_id, {S.CATEGORY} FROM sku", "sku")
def category_score(v: Views):
    names = v.table("part").select(F.col("p_partkey").alias("sku_id"), F.col("p_type").alias("id"))
    categories = v.type_categories().distinct()
    joined = joins.lookup_join(names, categories, "id").drop("id")
    return scoring.add_scores(joined, {"b1name": scoring.category_vector(F.col("b1name"))}).drop("b1name")


def order_feed(v: Views):
    orders, details = cdc.live(v.order_changes()), cdc.live(v.detail_changes())
    return flows.order_feed(orders, details, v.sku_dim(), v.type_categories())


BASE4 = f"""{LINE_COLUMNS}, c3id, tname, b1_name, {S.columns('pay_time')}, {S.columns('amount')},
    {S.columns('tname')}, {S.columns('b1name')}"""


@query(f"SELECT {BASE4} FROM base4", "base4")
def base4_feed(v: Views):
    return line_columns(order_feed(v))


ORDER_TOTALS = "[" + ", ".join(
    " + ".join(f'coalesce("{p}_{b}", 0)' for p in ("pay_time", "b1name", "tname", "amount")) for b in S.V.BUCKETS
) + "]"


@query(f"""SELECT uid, ts_ms, list_extract({S.NAMES}, list_position({ORDER_TOTALS}, list_max({ORDER_TOTALS}))) AS "ageLevel"
           FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts_ms DESC, detail_id DESC) AS rn FROM base4)
           WHERE rn = 1""", "base4")
def order_history_age_level(v: Views):
    return flows.order_age_levels(order_feed(v))


# --- Users -----------------------------------------------------------------------------------------------


@query("SELECT * FROM profile", "profile")
def user_profile_project(v: Views):
    return projections.with_uid(projections.user(v.user_changes(), AS_OF))


@query("SELECT uid, height, unit_height, weight, unit_weight, ts_ms AS create_ts, ts_ms FROM sup", "sup")
def user_supplement_project(v: Views):
    return projections.with_uid(projections.user_supplement(v.supplement_changes()))


def users_within(v: Views, days: int):
    return flows.user_feed(v.user_changes(), v.supplement_changes(), AS_OF, days * DAY_MS)


@query("SELECT uid, height, unit_height, weight, unit_weight, ts_ms FROM base6_day", "base6_day")
def user_sup_interval_join(v: Views):
    return users_within(v, 1).select("uid", "height", "unit_height", "weight", "unit_weight", "ts_ms")


@query("SELECT * FROM base6", "base6")
def base6_feed(v: Views):
    return users_within(v, 5)


# --- Final labels ----------------------------------------------------------------------------------------

PAIR = f"""
    SELECT b.*, {S.columns('pay_time')}, {S.columns('amount')}, {S.columns('tname')}, {S.columns('b1name')},
           o.ts_ms AS order_ts, o.detail_id
    FROM (SELECT uid, ts AS ts_ms, {S.columns('device')}, {S.columns('search')} FROM base2) b
    JOIN base4 o ON b.uid = o.uid AND o.ts_ms BETWEEN b.ts_ms - {24 * DAY_MS} AND b.ts_ms + {24 * DAY_MS}"""


@query(f"""SELECT uid, ts_ms, {S.AGE_LEVEL} AS "ageLevel" FROM (
             SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts_ms DESC, order_ts DESC, detail_id DESC) AS rn
             FROM ({PAIR})) WHERE rn = 1""", "base2", "base4")
def age_level_label(v: Views):
    return feed_joins.latest_age_levels(base2_feed(v), order_feed(v), hot_from=v.busy_users())


FINAL_LABEL = f"""SELECT b.*, "ageLevel" FROM (
             SELECT uid, "ageLevel", user_ts FROM (
               SELECT p.uid, {S.AGE_LEVEL} AS "ageLevel", u.ts_ms AS user_ts, row_number() OVER (
                 PARTITION BY p.uid ORDER BY p.ts_ms DESC, p.order_ts DESC, p.detail_id DESC, u.ts_ms DESC) AS rn
               FROM ({PAIR}) p JOIN base6 u
                 ON p.uid = u.uid AND u.ts_ms BETWEEN p.ts_ms - {24 * DAY_MS} AND p.ts_ms + {24 * DAY_MS})
             WHERE rn = 1) l JOIN base6 b ON l.uid = b.uid AND l.user_ts = b.ts_ms"""


@query(FINAL_LABEL, "base2", "base4", "base6")
def final_label_merge(v: Views):
    return flows.final_labels(base2_feed(v), order_feed(v), users_within(v, 5), hot_from=v.busy_users())


@query(FINAL_LABEL, "base2", "base4", "base6")
def staged_final_label(v: Views):
    """The same labels with the feeds handed over as tables: each is made once and read by column."""
    stages = jobs.Stages(session.shared_folder(v.spark))
    for name, rows in (("base2", base2_feed(v)), ("base4", order_feed(v)), ("base6", users_within(v, 5))):
        rows.write.parquet(stages.rows(name))
    return jobs.write_labels(v.spark, stages)


# --- Order sums per user ---------------------------------------------------------------------------------


def order_sums(v: Views):
    names = dimensions.sku_names(v.dictionary_skus(), v.dictionary())
    orders = v.order_changes("id", "create_time", "total_amount", "user_id")
    details = v.detail_changes("order_id", "sku_id")
    return flows.order_sums(cdc.live(orders), cdc.live(details), names, v.overrides())


@query(f"SELECT order_id, uid, ts_ms, sku_id, btname, bcname, {S.columns('sum')} FROM order_sum", "order_sum")
def order_sum_score(v: Views):
    return order_sums(v).select(
        "order_id", "uid", "ts_ms", "sku_id", "btname", "bcname", *scoring.score_columns("sum")
    )


USER_SUM = f"""
    SELECT u.*, {S.columns('sum')}, o.ts_ms AS order_ts, o.order_id FROM base6_day u
    JOIN order_sum o ON u.uid = o.uid AND o.ts_ms BETWEEN u.ts_ms - {30 * HOUR_MS} AND u.ts_ms + {30 * HOUR_MS}"""
ADDED = ", ".join(f'"sum_{b}" + "search_{b}" + coalesce("device_{b}", 0) AS "sum_{b}"' for b in S.V.BUCKETS)
USER_PAGE = f"""
    SELECT u.* EXCLUDE ({S.columns('sum')}), {ADDED}, b.ts AS page_ts FROM ({USER_SUM}) u
    JOIN base2 b ON u.uid = b.uid AND b.ts BETWEEN u.ts_ms - {12 * HOUR_MS} AND u.ts_ms + {12 * HOUR_MS}"""
SUM_VIEWS = ("base6_day", "order_sum", "base2")


@query(f"SELECT * EXCLUDE (order_ts, order_id) FROM ({USER_SUM})", *SUM_VIEWS)
def user_sum_interval_join_30h(v: Views):
    return feed_joins.users_with_order_sums(users_within(v, 1), order_sums(v), hot_from=v.order_users())


@query(f"SELECT * EXCLUDE (order_ts, order_id, page_ts) FROM ({USER_PAGE})", *SUM_VIEWS)
def user_sum_with_page_scores_12h(v: Views):
    order_users, page_users = v.order_users(), v.page_users()
    users = feed_joins.users_with_order_sums(users_within(v, 1), order_sums(v), hot_from=order_users)
    return feed_joins.users_with_page_scores(
        users, base2_feed(v), hot_from=page_users, left_hot_from=order_users
    )


def summed(prefix: str) -> str:
    return ", ".join(f'coalesce(sum({prefix}"sum_{b}"::DECIMAL(38,6)), 0)::DOUBLE AS "sum_{b}"' for b in S.V.BUCKETS)


@query(f"""SELECT u.*, t.* EXCLUDE (uid) FROM base6_day u JOIN (
             SELECT u.uid, count(o.uid) AS orders, {summed('o.')} FROM base6_day u LEFT JOIN order_sum o
               ON u.uid = o.uid AND o.ts_ms BETWEEN u.ts_ms - {30 * HOUR_MS} AND u.ts_ms + {30 * HOUR_MS}
             GROUP BY u.uid) t ON u.uid = t.uid""", *SUM_VIEWS)
def user_order_totals_30h(v: Views):
    """Number and total of the orders in reach of each user, by running sums."""
    return feed_joins.user_totals(users_within(v, 1), order_sums(v), hot_from=v.order_users())


@query(f"""SELECT u.*, t.* EXCLUDE (uid) FROM base6_day u JOIN (
             SELECT u.uid, (SELECT count(*) FROM order_sum o WHERE u.uid = o.uid AND o.ts_ms BETWEEN u.ts_ms - {30 * HOUR_MS} AND u.ts_ms + {30 * HOUR_MS}) AS orders,
                    (SELECT count(*) FROM base2 b WHERE u.uid = b.uid AND b.ts BETWEEN u.ts_ms - {12 * HOUR_MS} AND u.ts_ms + {12 * HOUR_MS}) AS pages, {summed('p.')}
             FROM base6_day u LEFT JOIN ({USER_PAGE}) p ON u.uid = p.uid GROUP BY u.uid, u.ts_ms) t ON u.uid = t.uid""", *SUM_VIEWS)
def user_page_totals_12h(v: Views):
    """The total over all orders and page rows in reach of each user, without forming them."""
    return feed_joins.user_totals(users_within(v, 1), order_sums(v), base2_feed(v), hot_from=v.busy_users())


@query(f"""SELECT * EXCLUDE (order_ts, order_id, page_ts, rn) FROM (
             SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts_ms DESC, order_ts DESC, order_id DESC, page_ts DESC) AS rn
             FROM ({USER_PAGE})) WHERE rn = 1""", *SUM_VIEWS)
def user_latest_only(v: Views):
    return flows.user_sums(users_within(v, 1), order_sums(v), base2_feed(v), hot_from=v.busy_users())


# --- Lookups and keys ------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, o_custkey, c_name AS dim_c_name, c_mktsegment AS dim_c_mktsegment FROM orders
          LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def dim_lookup_left(v: Views):
    dim = v.table("customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return joins.lookup_join(
        v.table("orders").select("o_orderkey", "o_custkey"), dim, "o_custkey", ["c_name", "c_mktsegment"], "dim_"
    )


@query(f"""
    WITH changes AS (SELECT o_custkey AS id, {S.order_time('o_orderkey')} AS at, {S.order_time('o_orderkey')}::HUGEINT * 1000000000 + o_orderkey AS place,
                            o_orderkey % 10 = 0 AS gone, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS level, o_totalprice AS price FROM orders),
    met AS (SELECT e.event_id, c.* FROM (SELECT event_id, user_id, epoch_us(ts) // 1000 AS t FROM events) e
            JOIN changes c ON e.user_id = c.id AND c.at <= e.t),
    deleted AS (SELECT event_id, max(place) AS place FROM met WHERE gone GROUP BY event_id),
    alive AS (SELECT m.* FROM met m LEFT JOIN deleted d ON m.event_id = d.event_id WHERE NOT m.gone AND (d.place IS NULL OR m.place > d.place))
    SELECT e.event_id, e.user_id, a.level AS dim_level, a.price AS dim_price FROM events e LEFT JOIN (
      SELECT event_id, arg_max(level, place) FILTER (level IS NOT NULL) AS level, arg_max(price, place) AS price FROM alive GROUP BY event_id) a
      ON e.event_id = a.event_id""")
def asof_dim_lookup(v: Views):
    """Events with the user's data as it was then; every tenth change is a delete, every third leaves the level as it is."""
    key = F.col("o_orderkey")
    changes = v.table("orders").select(
        F.col("o_custkey").alias("user_id"), F.when(key % 10 == 0, "d").otherwise("u").alias("op"), order_time(key).alias("at"), key.alias("seq"),
        F.when(key % 3 != 0, F.col("o_orderpriority")).alias("level"), F.col("o_totalprice").alias("price"),
    )
    events = v.table("events").select("event_id", "user_id", dates.wall_clock_millis(F.col("ts")).alias("t"))
    return history.asof_lookup(events, changes, "user_id", "t", ["level", "price"], ["at", "seq"], "dim_").drop("t")


@query(f"""SELECT d.order_id, d.detail_id, d.ts_ms, o.id AS info_id, o.order_id AS info_order_id, o.uid AS info_uid, o.ts_ms AS info_ts_ms
           FROM detail_raw d JOIN (SELECT id, id AS order_id, uid, ts_ms FROM order_raw) o ON d.order_id = o.order_id
            AND o.ts_ms BETWEEN d.ts_ms - {2 * HOUR_MS} AND d.ts_ms + {HOUR_MS}""", "detail_raw", "order_raw")
def comment_order_prefix_join(v: Views):
    comments = v.detail_changes("order_id", "id").select("after.order_id", F.col("after.id").alias("detail_id"), "ts_ms")
    orders = v.order_changes("id", "user_id").select(
        "after.id", F.col("after.id").alias("order_id"), F.col("after.user_id").alias("uid"), "ts_ms"
    )
    return feed_joins.comments_with_orders(comments, orders, "order_id", -2 * HOUR_MS, HOUR_MS)


BUCKET = "lpad((('0x' || right(md5({0}), 3))::INTEGER % 128)::VARCHAR, 4, '0')"


@query(f"SELECT c_custkey, {BUCKET.format('c_custkey::VARCHAR')} AS bucket FROM customer")
def hash_bucket_128(v: Views):
    return v.table("customer").select("c_custkey", text.hash_bucket(F.col("c_custkey")).alias("bucket"))


@query(f"""SELECT o_orderkey, CASE WHEN lower(k) = '0x' || repeat('0', 39) || '1' THEN '9006'
             WHEN lower(k) = '0x' || repeat('0', 40) THEN '9001' ELSE {BUCKET.format('k')} END AS bucket
           FROM (SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN '0X' ELSE '0x' END || repeat('0', 39) ||
                   CASE WHEN o_custkey % 3 = 0 THEN '1' ELSE o_orderkey::VARCHAR END AS k FROM orders)""")
def hash_bucket_hot_keys(v: Views):
    hot = F.col("o_custkey") % 3 == 0
    key = F.concat(
        F.when(hot, "0X").otherwise("0x"), F.repeat(F.lit("0"), F.lit(39)),
        F.when(hot, "1").otherwise(F.col("o_orderkey").cast("string")),
    )
    return v.table("orders").select("o_orderkey", text.hot_key_bucket(key).alias("bucket"))


@query("""SELECT c_custkey, md5(c_nationkey::VARCHAR) || '|' || c_custkey AS key,
                 md5(c_nationkey || '_' || c_custkey) AS hashed FROM customer""")
def row_key_compose(v: Views):
    item = text.KeyItem
    return v.table("customer").select(
        "c_custkey",
        text.row_key([item("c_nationkey", md5=True), item("c_custkey")], "|").alias("key"),
        text.row_key([item("c_nationkey"), item("c_custkey")], "_", md5=True).alias("hashed"),
    )


@query("SELECT c_custkey AS cCustkey, c_name AS cName, c_acctbal AS cAcctbal FROM customer")
def camel_case_columns(v: Views):
    return text.camel_case_columns(v.table("customer").select("c_custkey", "c_name", "c_acctbal"))


# --- Column helpers --------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, coalesce(array_to_string([strftime(d, '%Y%m%d') for d in generate_series(f, t, INTERVAL 1 DAY)], ','), '') AS days, greatest(date_diff('day', f, t) + 1, 0)::INTEGER AS n
          FROM (SELECT o_orderkey, o_orderdate::DATE AS f, (o_orderdate::DATE + (o_orderkey % 12 - 4)::INTEGER) AS t FROM orders)""")
def day_partition_range(v: Views):
    first = F.col("o_orderdate").cast("date")
    days = dates.day_partitions(first, F.date_add(first, (F.col("o_orderkey") % 12 - 4).cast("int")))
    return v.table("orders").select(
        "o_orderkey", F.array_join(days.cast("array<string>"), ",").alias("days"), F.size(days).alias("n")
    )


@query("""SELECT event_id, strftime(t, '%Y-%m-%d') AS d, strftime(t, '%Y-%m-%d %H:%M:%S') AS dt, strftime(t, '%Y%m%d') AS p,
                 strftime(ts, '%Y/%m/%d %H') AS f FROM (SELECT event_id, ts, ts + INTERVAL 8 HOUR AS t FROM events)""")
def epoch_to_dates(v: Views):
    ms = dates.wall_clock_millis(F.col("ts"))
    return v.table("events").select(
        "event_id", dates.millis_to_date(ms).alias("d"), dates.millis_to_datetime(ms).alias("dt"),
        dates.millis_to_partition(ms).alias("p"), dates.format_date(F.col("ts"), "yyyy/MM/dd HH").alias("f"),
    )


@query("""SELECT event_id, epoch_us(date_trunc('second', ts)) // 1000 - 28800000 AS ms,
                 epoch_us(ts::DATE::TIMESTAMP) // 1000 - 28800000 AS day_ms, NULL::BIGINT AS bad FROM events""")
def datetime_to_epoch(v: Views):
    written = F.substring(F.col("ts").cast("string"), 1, 19)
    return v.table("events").select(
        "event_id", dates.datetime_to_millis(written).alias("ms"),
        dates.date_to_millis(F.substring(written, 1, 10)).alias("day_ms"),
        dates.datetime_to_millis(F.concat(F.lit("x"), written)).alias("bad"),
    )


@query("""SELECT c_custkey, array_to_string(['0x' || substring(d, 3 + 64 * i, 64) for i in range(0, (length(d) - 2) // 64)], ',') AS words
          FROM (SELECT c_custkey, '0x' || repeat(md5(c_name), (c_custkey % 7)::INTEGER) AS d FROM customer)""")
def hex_words_split(v: Views):
    data = F.concat(F.lit("0x"), F.repeat(F.md5("c_name"), (F.col("c_custkey") % 7).cast("int")))
    return v.table("customer").select("c_custkey", F.array_join(text.hex_words(data), ",").alias("words"))


#: Numbers of 200 to 256 bits.
WIDE = (2**256 - 1, 2**255 + 10**18, 3**150, 10**60 + 7, 2**200)


@query(f"""SELECT o_orderkey, o_orderkey::VARCHAR AS from_hex, o_orderkey::VARCHAR AS from_text, '0' AS missing,
                  (o_orderkey * 1000)::VARCHAR AS ether, (o_orderkey::HUGEINT * 18446744073709551616 + o_custkey)::VARCHAR AS wide,
                  {S.pick([str(n) for n in WIDE], 'o_orderkey % 5')} AS wider,
                  o_custkey || '.' || lpad(o_orderkey::VARCHAR, 18, '0') || '9' AS fine FROM orders""")
def hex_to_decimal(v: Views):
    key = F.col("o_orderkey")
    convert = numbers.hex_or_decimal_to_text
    fine = F.concat(F.col("o_custkey").cast("string"), F.lpad(key.cast("string"), 18, "0"))
    return v.table("orders").select(
        "o_orderkey",
        convert(F.concat(F.lit("0x"), F.lower(F.hex(key)))).alias("from_hex"),
        convert(key.cast("string")).alias("from_text"),
        convert(F.when(key < 0, F.lit("0"))).alias("missing"),
        convert(F.concat((key * 1000).cast("string"), F.repeat(F.lit("0"), F.lit(18))), in_ether=True).alias("ether"),
        convert(F.concat(F.lit("0x"), F.hex(key), F.lpad(F.hex("o_custkey"), 16, "0"))).alias("wide"),
        convert(pick([hex(n) for n in WIDE], key % 5)).alias("wider"),
        convert(F.concat(fine, F.lit(".9")), in_ether=True).alias("fine"),
    )


@query("""SELECT c_custkey, '["' || c_name || '","' || c_mktsegment || '"]' AS appended,
                 '["' || c_mktsegment || '"]' AS started FROM customer""")
def json_list_append(v: Views):
    listed = F.to_json(F.array("c_name"))
    return v.table("customer").select(
        "c_custkey",
        text.append_to_json_list(listed, F.col("c_mktsegment")).alias("appended"),
        text.append_to_json_list(F.lit(None).cast("string"), F.col("c_mktsegment")).alias("started"),
    )


@query("""SELECT p_partkey, upper(p_name[1]) || p_name[2:] AS up, lower(p_type[1]) || p_type[2:] AS low,
                 repeat('0', p_size) AS zeros, p_partkey % 3 = 0 AS blank, p_partkey % 3 = 0 AND p_partkey % 2 = 0 AS empty,
                 p_name || ', null, ' || p_type AS listed, split_part(p_name, ' ', 1) AS first,
                 p_partkey % 3 <> 0 AS allowed FROM part""")
def string_helpers(v: Views):
    key = F.col("p_partkey")
    gap = F.when(key % 3 == 0, F.when(key % 2 == 0, "").otherwise("\t \n")).otherwise(F.col("p_brand"))
    return v.table("part").select(
        "p_partkey",
        text.upper_first(F.col("p_name")).alias("up"),
        text.lower_first(F.col("p_type")).alias("low"),
        text.zeros(F.col("p_size")).alias("zeros"),
        text.is_blank(gap).alias("blank"),
        text.is_empty(gap).alias("empty"),
        text.join_list(F.array("p_name", F.lit(None), "p_type")).alias("listed"),
        text.first_word(F.col("p_name")).alias("first"),
        text.is_allowed_text(gap).alias("allowed"),
    )
