"""Streaming and file-sink queries: run over whole tables, written to the shared folder, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.batch_queries import AS_OF, FINAL_LABEL, flat_page, keywords, order_feed
from catalog.registry import query
from catalog.views import START_MS, Views
from tidemark import session
from tidemark.functions import dates
from tidemark.functions.dates import DAY_MS, HOUR_MS, MINUTE_MS
from tidemark.operators import cdc, dedup, projections
from tidemark.plans import jobs
from tidemark.sinks import buckets, files, topics
from tidemark.sources import dimensions, feeds
from tidemark.streaming import flows, joins, runs, state, times
from tidemark.streaming.times import EVENT_TIME, with_event_time


class StreamViews(Views):
    """The same views over file streams."""

    def table(self, name: str) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.folder}/{name}.parquet").schema
        return (
            self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)
        )


def streams(v: Views) -> StreamViews:
    return StreamViews(v.spark, v.folder)


def run(rows: DataFrame, idle: bool = True) -> DataFrame:
    return runs.run_to_files(rows, session.shared_folder(rows.sparkSession), idle)


@query("SELECT id, uid, ts_ms, detail_id, sku_id FROM lines", "lines")
def stream_interval_join(v: Views):
    s = streams(v)
    orders = with_event_time(projections.order(cdc.live(s.order_changes())).select("id", "uid", "ts_ms"), "ts_ms")
    details = with_event_time(
        projections.order_detail(cdc.live(s.detail_changes())).select(
            F.col("order_id"), F.col("id").alias("detail_id"), "sku_id", F.col("ts_ms").alias("detail_ts")
        ), "detail_ts",
    ).drop("detail_ts").withColumnRenamed("order_id", "id")
    return run(joins.interval_join(orders, details, "id", -2 * HOUR_MS, 2 * HOUR_MS).drop(EVENT_TIME), idle=False)


@query("SELECT DISTINCT detail_id, ts_ms, uid, order_id FROM lines", "lines")
def stream_monotone_dedup_ttl(v: Views):
    s = streams(v)
    lines = flows.order_lines(
        projections.with_id(projections.order(cdc.live(s.order_changes()))),
        projections.with_id(projections.order_detail(cdc.live(s.detail_changes())), "order_id"),
        columns=("detail_id", "ts_ms", "uid", "order_id"),
    )
    return run(lines, idle=False)


@query("SELECT DISTINCT uid, ts, os, ch, md, ba, ar, vc, search_item FROM page_log", "page_log")
def stream_full_row_dedup(v: Views):
    """All page logs, a third of them twice."""
    logs = streams(v).page_logs()
    again = streams(v).page_logs().filter(F.col("event_id") % 3 == 0)
    pages = projections.with_uid(projections.page(logs.unionByName(again)))
    return run(flat_page(state.distinct_rows(with_event_time(pages, "ts"))))


CLOSING = "closing row"


def with_closing_rows(pages: DataFrame) -> DataFrame:
    """Pages, and for each a row of a user of its own some windows later, so that all windows of the others close.

    The rows of one window are equal, so that of each window one stays in the state that knows what was seen. Whoever reads
    the result leaves that user out.
    """
    window = 2 * MINUTE_MS
    later = F.floor(F.col("ts") / window).cast("bigint") * window + 3 * window
    same = {c: F.lit(None).cast(t) for c, t in pages.dtypes if c not in ("uid", "ts", "deviceInfo")}
    device = F.struct(*[F.lit("").cast(f.dataType).alias(f.name) for f in pages.schema["deviceInfo"].dataType])
    return pages.unionByName(pages.withColumns({"uid": F.lit(CLOSING), "ts": later, "deviceInfo": device, **same}))


@query("SELECT * FROM snapshot", "snapshot")
def stream_running_state(v: Views):
    pages = projections.with_uid(projections.page(streams(v).page_logs()))
    return run(flows.page_snapshots(with_closing_rows(pages), ttl_ms=None)).filter(F.col("uid") != CLOSING)


COUNTED = ("os", "ch", "md", "ba", "search_item")


@query(f"""SELECT uid, pv, window_start, ts, {', '.join(f"len(string_split({f}, ',')) - ({f} = '')::INTEGER AS {f}_count" for f in COUNTED)} FROM snapshot""", "snapshot")
def stream_running_counts(v: Views):
    """Running numbers of distinct values: each value counts in its first window and is read from state by its name only."""
    pages = projections.with_uid(projections.page(streams(v).page_logs()))
    rows = run(flows.page_snapshots(with_closing_rows(pages), ttl_ms=None, lists=False))
    return rows.filter(F.col("uid") != CLOSING).drop(*[f"{f}_new" for f in COUNTED])


@query("SELECT * EXCLUDE window_start, ts AS ts_ms FROM base2", "base2")
def stream_base2_feed(v: Views):
    """The page feed as a stream in which a third of the page logs comes twice."""
    logs = streams(v).page_logs()
    again = streams(v).page_logs().filter(F.col("event_id") % 3 == 0)
    pages = projections.with_uid(projections.page(logs.unionByName(again)))
    rows = run(flows.page_feed(with_closing_rows(pages), keywords(v), ttl_ms=None))
    return rows.filter(F.col("uid") != CLOSING).drop("window_start")


@query("""SELECT e.event_id, e.user_id, c.c_name AS d_name FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def stream_dim_lookup(v: Views):
    """Events looked up in a dimension that is read again for every batch."""
    folder = session.shared_folder(v.spark)
    events = streams(v).table("events").select("event_id", "user_id")
    dim = lambda: v.table("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    write = runs.enriched(dim, "user_id", files.batch_folders(f"{folder}/rows", "parquet"), prefix="d_")
    writer = events.writeStream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(write)
    runs.start(writer, v.spark, trigger=None).awaitTermination()
    return v.spark.read.parquet(f"{folder}/rows").select("event_id", "user_id", "d_name")


@query(f"""SELECT uid, window_start, ts, event_id, ch FROM (
             SELECT uid, ts // {2 * MINUTE_MS} * {2 * MINUTE_MS} AS window_start, ts, event_id, ch,
                    row_number() OVER (PARTITION BY uid, ts // {2 * MINUTE_MS} ORDER BY ts DESC, event_id DESC) AS rn
             FROM page_log) WHERE rn = 1""", "page_log")
def stream_window_last(v: Views):
    """Every window, open ones included: updated windows are written per batch and the last batch counts."""
    pages = with_event_time(
        streams(v).page_logs().select(
            F.col("common.uid").alias("uid"), "ts", "event_id", F.col("common.ch").alias("ch")
        ), "ts",
    )
    last = pages.groupBy(F.window(EVENT_TIME, "2 minutes"), "uid").agg(
        F.max_by(F.struct("ts", "event_id", "ch"), F.struct("ts", "event_id")).alias("_row")
    ).select("uid", F.unix_millis("window.start").alias("window_start"), "_row.*")
    folder = session.shared_folder(v.spark)
    writer = (
        last.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(files.batch_folders(f"{folder}/rows", "parquet"))
    )
    runs.start(writer, v.spark, trigger=None).awaitTermination()
    written = v.spark.read.schema(f"{schema_of(last)}, batch BIGINT").parquet(f"{folder}/rows")
    return dedup.latest(written, ["uid", "window_start"], ["batch"]).drop("batch")


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


@query("""SELECT uid, ts, event_id, ch FROM (
            SELECT uid, ts, event_id, ch, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn FROM page_log)
          WHERE rn = 1""", "page_log")
def stream_processing_window(v: Views):
    """The last page of each user in a window of processing time, here one into which all pages come."""
    pages = streams(v).page_logs().select(F.col("common.uid").alias("uid"), "ts", "event_id", F.col("common.ch").alias("ch"))
    last = state.last_in_processing_window(pages, "uid", ("ts", "event_id"), PROCESSING_WINDOW_MS)
    return runs.run_until_timers_end(last, session.shared_folder(v.spark)).drop(state.WINDOW_END)


#: Short, so that the query ends soon.
PROCESSING_WINDOW_MS = 2000

JOINED_TIME = "greatest(o.ts_ms, d.ts_ms)"


@query(f"""SELECT * FROM (
    WITH joined AS (SELECT o.uid, d.detail_id, {JOINED_TIME} AS t FROM order_raw o JOIN detail_raw d ON o.id = d.order_id
        AND d.ts_ms BETWEEN o.ts_ms - {2 * HOUR_MS} AND o.ts_ms + {2 * HOUR_MS} WHERE o.op <> 'd'),
    hours AS (SELECT uid, (t // {HOUR_MS} * {HOUR_MS})::BIGINT AS window_start, count(*) AS lines, max(t) AS last_ts, arg_max(detail_id, (t, detail_id)) AS last_line
        FROM joined GROUP BY uid, window_start HAVING window_start + {HOUR_MS} <= (SELECT max(t) - 5000 FROM joined)),
    days AS (SELECT uid, (last_ts // {DAY_MS} * {DAY_MS})::BIGINT AS day_start, count(*) AS hours, sum(lines)::BIGINT AS lines, max(last_line) AS last_line
        FROM hours GROUP BY uid, day_start HAVING day_start + {DAY_MS} <= (SELECT max(last_ts) FROM hours))
    SELECT * FROM days)""", "order_raw", "detail_raw")
def stream_restamped_window(v: Views):
    """Lines per user and hour, then per day: stamped anew after the join and after the first window."""
    s = streams(v)
    orders = with_event_time(projections.order(cdc.live(s.order_changes())).select("id", "uid", "ts_ms"), "ts_ms")
    details = with_event_time(
        projections.order_detail(cdc.live(s.detail_changes())).select(
            F.col("order_id").alias("id"), F.col("id").alias("detail_id"), F.col("ts_ms").alias("detail_ts")
        ), "detail_ts",
    )
    joined = joins.interval_join(orders, details, "id", -2 * HOUR_MS, 2 * HOUR_MS).drop(EVENT_TIME)
    lines = times.restamped(handed_over(joined, idle=False), "ts_ms", "detail_ts", lateness=times.LATENESS_AFTER_JOIN)
    line_time = F.greatest("ts_ms", "detail_ts")
    hours = lines.groupBy(F.window(EVENT_TIME, "1 hour"), "uid").agg(
        F.count("*").alias("lines"), F.max(line_time).alias("last_ts"),
        F.max_by("detail_id", F.struct(line_time.alias("t"), "detail_id")).alias("last_line"),
    ).select("uid", "lines", "last_ts", "last_line")
    stamped = times.restamped(handed_over(hours), "last_ts", lateness=times.LATENESS_AFTER_WINDOW)
    days = stamped.groupBy(F.window(EVENT_TIME, "1 day"), "uid").agg(
        F.count("*").alias("hours"), F.sum("lines").alias("lines"), F.max("last_line").alias("last_line")
    )
    return run(days.select("uid", F.unix_millis("window.start").alias("day_start"), "hours", "lines", "last_line"))


def handed_over(rows: DataFrame, idle: bool = True) -> DataFrame:
    """Rows of a stream written to a feed of their own and read from there as another stream.

    An inner join gives no rows in idle batches, so the last one before it ends needs none; state that is too old goes with
    the next batch of data.
    """
    folder = session.shared_folder(rows.sparkSession)
    runs.run_to_files(rows, folder, idle)
    return runs.read_files(rows.sparkSession, folder, rows.schema)


@query(FINAL_LABEL, "base2", "base4", "base6")
def stream_chained_label(v: Views):
    """Three feeds handed over, then the last label of each user kept in state by a stream over them.

    Of equal lines of one time a stream takes the one that comes first; so that one is sure, the batch flow writes base4.
    """
    s = streams(v)
    stages = jobs.Stages(session.shared_folder(v.spark))
    pages = projections.with_uid(projections.page(s.page_logs()))
    base2 = flows.page_feed(with_closing_rows(pages), keywords(v), ttl_ms=None).filter(F.col("uid") != CLOSING)
    base6 = flows.user_feed(
        projections.with_uid(projections.user(s.user_changes(), AS_OF)),
        projections.with_uid(projections.user_supplement(s.supplement_changes())),
    )
    for name, rows in (("base2", base2), ("base6", base6)):
        runs.run_to_files(rows, stages.folder(name), idle=name == "base2")
    order_feed(v).write.parquet(stages.rows("base4"))
    jobs.start_labels(v.spark, stages, None).awaitTermination()
    written = v.spark.read.parquet(stages.rows("labels"))
    newest = dedup.latest(written, "uid", ["page_ts_ms", "order_ts_ms", "ts_ms"])
    return newest.drop("page_ts_ms", "order_ts_ms")


@query("SELECT DISTINCT uid, ts FROM page_log", "page_log")
def stream_user_dedup_ttl(v: Views):
    """Times of each user's pages, each passed once; a user's last time is known for one day."""
    pages = streams(v).page_logs().select(F.col("common.uid").alias("uid"), "ts")
    return run(state.increasing_only(pages, "uid", "ts", DAY_MS), idle=False)


@query("SELECT uid, window_start, ch, count(*) AS views FROM (SELECT DISTINCT uid, ts, os, ch, md, ba FROM page_log) GROUP BY ALL".replace(
    "window_start,", f"(ts // {HOUR_MS} * {HOUR_MS})::BIGINT AS window_start,"), "page_log")
def stream_restart(v: Views):
    """Pages per user, channel and hour without copies, by a query that is stopped twice and goes on from its checkpoint."""
    source = session.shared_folder(v.spark)
    pages = projections.page(v.page_logs()).select("uid", "ts", "deviceInfo")
    pages.repartition(6, "uid").write.parquet(f"{source}/pages")
    rows = v.spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/pages")
    timed = with_event_time(rows.select("uid", "ts", "deviceInfo.os", "deviceInfo.ch", "deviceInfo.md", "deviceInfo.ba"), "ts", lateness="40 days")
    hours = state.distinct_rows(timed).groupBy(F.window(EVENT_TIME, "1 hour"), "uid", "ch").agg(F.count("*").alias("views"))
    counted = hours.select("uid", F.unix_millis("window.start").alias("window_start"), "ch", "views")
    writer = (
        counted.writeStream.outputMode("update").option("checkpointLocation", f"{source}/checkpoint")
        .foreachBatch(files.batch_folders(f"{source}/rows", "parquet"))
    )
    runs.run_with_stops(writer, v.spark, stops=2)
    written = v.spark.read.schema(f"{schema_of(counted)}, batch BIGINT").parquet(f"{source}/rows")
    return dedup.latest(written, ["uid", "window_start", "ch"], ["batch"]).drop("batch")


# --- File sinks ------------------------------------------------------------------------------------------


@query("SELECT uid, uname, age, zodiac_sign FROM profile", "profile")
def text_label_sink_round_trip(v: Views):
    folder = session.shared_folder(v.spark)
    labels = projections.user(v.user_changes(), AS_OF).select("uid", "uname", "age", "zodiac_sign")
    files.write_text(labels, folder)
    lines = feeds.text_feed(v.spark, feeds.folder(folder))
    return lines.select(F.from_json("value", labels.schema).alias("r")).select("r.*")


@query("SELECT event_id, user_id, event_type, value FROM events")
def json_lines_round_trip(v: Views):
    folder = session.shared_folder(v.spark)
    v.table("events").select("event_id", "user_id", "event_type", "value").write.json(folder)
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
    return feeds.json_lines(v.spark, folder, schema, modified_after="2020-01-01T00:00:00")


@query("""SELECT event_id, user_id, strftime(ts + INTERVAL 8 HOUR, '%Y%m%d')::INTEGER AS dt FROM events
          WHERE strftime(ts + INTERVAL 8 HOUR, '%Y%m%d')::INTEGER BETWEEN 20240105 AND 20240107""")
def partitioned_layout_prune(v: Views):
    """Three days of a table partitioned by day, read by a list of day numbers."""
    folder = session.shared_folder(v.spark)
    ms = dates.wall_clock_millis(F.col("ts"))
    rows = v.table("events").select("event_id", "user_id", dates.millis_to_partition(ms).cast("int").alias("dt"))
    files.write_table(rows, files.Layout(folder, partitioned=True, field="dt"))
    days = dates.day_partitions(F.lit("2024-01-05").cast("date"), F.lit("2024-01-07").cast("date"))
    stored = v.spark.read.schema("event_id BIGINT, user_id BIGINT, dt INT").parquet(folder)
    return stored.filter(F.array_contains(days, F.col("dt")))


@query("""SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS topic, o_orderkey AS id FROM orders""")
def topic_routing_partitioned(v: Views):
    folder = session.shared_folder(v.spark)
    key = F.col("o_orderkey")
    rows = v.table("orders").select(key.alias("id"), F.when(key % 2 == 0, "even").otherwise("odd").alias("sink_table"))
    files.write_routed(topics.routed(rows), folder, "topic")
    stored = v.spark.read.schema("value STRING, topic STRING").parquet(folder)
    return stored.select("topic", F.get_json_object("value", "$.id").cast("bigint").alias("id"))


DIMENSION_AFTER = """
    WITH changes AS (SELECT o_custkey AS id, o_orderkey AS seq, CASE WHEN o_orderkey % 10 = 0 THEN 'd' ELSE 'u' END AS op,
                            CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS name FROM orders),
    everything AS (SELECT * FROM changes UNION ALL SELECT c_custkey, -1, 'r', c_name FROM customer),
    alive AS (SELECT e.* FROM everything e LEFT JOIN (SELECT id, max(seq) AS gone FROM changes WHERE op = 'd' GROUP BY id) g
        ON e.id = g.id WHERE e.op <> 'd' AND (g.gone IS NULL OR e.seq > g.gone))
    SELECT id, arg_max(name, seq) FILTER (name IS NOT NULL) AS name FROM alive GROUP BY id"""


@query(DIMENSION_AFTER)
def stream_dimension_versions(v: Views):
    """A change stream kept applied to a versioned dimension."""
    folder = session.shared_folder(v.spark)
    v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).write.parquet(
        f"{folder}/dim/version=0"
    )
    writer = named_changes(v).writeStream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(
        files.dimension_versions(f"{folder}/dim", "id", ["name"], ["seq"])
    )
    runs.start(writer, v.spark, trigger=None).awaitTermination()
    return dimensions.current_version(v.spark, f"{folder}/dim")


@query(DIMENSION_AFTER)
def stream_bucketed_dimension(v: Views):
    """The same changes in a dimension of which each batch rewrites only the buckets it touches."""
    folder = session.shared_folder(v.spark)
    dim = buckets.Dimension(v.spark, f"{folder}/dim", "id", ["name"])
    dim.create(v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    writer = named_changes(v).writeStream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(
        buckets.bucketed_versions(dim, ["seq"])
    )
    runs.start(writer, v.spark, trigger=None).awaitTermination()
    return dim.read()


def named_changes(v: Views) -> DataFrame:
    """Orders as a change stream of customers' names."""
    key = F.col("o_orderkey")
    return streams(v).table("orders").select(
        F.col("o_custkey").alias("id"), key.alias("seq"), F.when(key % 10 == 0, "d").otherwise("u").alias("op"),
        F.when(key % 3 != 0, F.col("o_orderpriority")).alias("name"),
    )


@query("""SELECT o_custkey AS id, max(o_orderkey) AS seq, arg_max(o_orderpriority, o_orderkey) AS name FROM orders GROUP BY o_custkey""")
def topic_upsert_round_trip(v: Views):
    """Rows written as key and value, of which the last per key counts."""
    folder = session.shared_folder(v.spark)
    rows = v.table("orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("name"))
    topics.upsert(rows, "id").write.parquet(folder)
    stored = v.spark.read.schema("key STRING, value STRING").parquet(folder)
    read = stored.select(F.from_json("value", rows.schema).alias("r")).select("r.*", F.lit("u").alias("op"))
    return cdc.latest_per_key(read, "id", ["seq"]).drop("op")


@query("SELECT uid, count(*) AS n, sum(age)::BIGINT AS ages FROM profile GROUP BY uid", "profile")
def feed_view_sql(v: Views):
    """A feed under a name, asked in SQL."""
    feeds.feed_view("user_feed", projections.user(v.user_changes(), AS_OF).select("uid", "age"))
    return v.spark.sql("SELECT uid, count(*) AS n, sum(age) AS ages FROM user_feed GROUP BY uid")


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def dimension_view_lookup(v: Views):
    """A dimension under a name, joined in SQL."""
    dimensions.dimension_view("customer_dim", v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    feeds.feed_view("order_feed", v.table("orders").select("o_orderkey", "o_custkey"))
    return v.spark.sql("SELECT o.o_orderkey, d.name AS c_name FROM order_feed o LEFT JOIN customer_dim d ON o.o_custkey = d.id")


@query("""SELECT o_orderkey, o_totalprice AS "sum_18_24", o_totalprice * 2 AS "sum_50", o_custkey AS other FROM orders""")
def plain_bucket_names(v: Views):
    price = F.col("o_totalprice")
    rows = v.table("orders").select("o_orderkey", price.alias("sum_18~24"), (price * 2).alias("sum_50"), F.col("o_custkey").alias("other"))
    return projections.plain_bucket_names(rows)


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id * 10 ELSE event_id END * 1000 AS ms FROM events""")
def block_event_time(v: Views):
    """Event time of a stream from the block's seconds, else the record's."""
    key = F.col("event_id")
    rows = streams(v).table("events").select("event_id", F.when(key % 2 == 0, key * 10).alias("block_timestamp"), key.alias("timestamp"))
    return run(times.with_block_time(rows, "0 seconds").select("event_id", F.unix_millis(EVENT_TIME).alias("ms")))
