"""Streams over several batches, against the batch form of the same operator."""

import json
import os

import pytest
from pyspark.sql import functions as F

from catalog.stream_queries import with_closing_rows
from tidemark import session
from tidemark.operators import joins as batch_joins
from tidemark.operators import running
from tidemark.sinks import files, topics
from tidemark.sources import dimensions, feeds
from tidemark.streaming import flows, joins, runs, state, times


def add_batch(path, number, rows):
    """One input file; files are read in the order of their times."""
    os.makedirs(path, exist_ok=True)
    name = f"{path}/{number:03d}.json"
    with open(name, "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in rows)
    os.utime(name, (1_700_000_000 + number, 1_700_000_000 + number))


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def run(rows, folder, idle=True):
    return runs.run_to_files(rows, str(folder), idle)


def test_increasing_only_over_batches(spark, tmp_path):
    source = f"{tmp_path}/in"
    for number, rows in enumerate([[(5, "a"), (3, "b")], [(4, "c"), (6, "d"), (6, "e")], [(6, "f"), (9, "g")]]):
        add_batch(source, number, [{"k": "x", "ts_ms": t, "v": v} for t, v in rows])
    rows = stream(spark, source, "k STRING, ts_ms BIGINT, v STRING")
    got = run(state.increasing_only(rows, "k", ttl_ms=None), tmp_path / "out")
    assert sorted(r["ts_ms"] for r in got.collect()) == [3, 5, 6, 9]


def test_state_expires(spark, tmp_path):
    source = f"{tmp_path}/in"
    add_batch(source, 0, [{"k": "x", "ts_ms": 5}])
    add_batch(source, 1, [{"k": "x", "ts_ms": 4}])
    rows = stream(spark, source, "k STRING, ts_ms BIGINT")
    got = run(state.increasing_only(rows, "k", ttl_ms=1), tmp_path / "out", idle=False)
    assert sorted(r["ts_ms"] for r in got.collect()) == [4, 5]


def test_running_sets_over_batches(spark, tmp_path):
    source = f"{tmp_path}/in"
    data = [
        {"uid": f"u{i % 3}", "ts": i, "os": "iOS" if i % 4 else "Android", "ch": "abc"[i % 3], "md": f"m{i % 5}",
         "ba": None if i % 7 == 0 else "z", "search_item": "k" if i % 6 == 0 else None}
        for i in range(60)
    ]
    for number in range(3):
        add_batch(source, number, data[number * 20: number * 20 + 20])
    schema = "uid STRING, ts BIGINT, os STRING, ch STRING, md STRING, ba STRING, search_item STRING"
    fields = ("os", "ch", "md", "ba", "search_item")
    rows = stream(spark, source, schema).withColumn("ba", F.coalesce("ba", F.lit("null")))
    got = run(state.running_sets(rows, "uid", "ts", fields, ("ts",), ttl_ms=None), tmp_path / "out")
    pages = spark.read.schema(schema).json(source).select(
        "uid", "ts", F.struct("os", "ch", "md", "ba").alias("deviceInfo"), "search_item"
    )
    want = running.page_statistics(pages)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_distinct_rows_over_batches(spark, tmp_path):
    source = f"{tmp_path}/in"
    add_batch(source, 0, [{"k": "a", "ts": 1000}, {"k": "a", "ts": 1000}])
    add_batch(source, 1, [{"k": "a", "ts": 1000}, {"k": "b", "ts": 1000}])
    rows = stream(spark, source, "k STRING, ts BIGINT")
    assert run(state.distinct_rows(rows), tmp_path / "all").count() == 2
    timed = times.with_event_time(rows, "ts", lateness="1 hour")
    assert run(state.distinct_rows(timed, "k", "ts", bounded=True), tmp_path / "bounded").count() == 2


def test_interval_join_bounds_over_batches(spark, tmp_path):
    left, right = f"{tmp_path}/l", f"{tmp_path}/r"
    add_batch(left, 0, [{"k": "a", "ts": 100_000}])
    add_batch(right, 0, [{"k": "a", "rt": 89_999}, {"k": "a", "rt": 90_000}])
    add_batch(left, 1, [{"k": "b", "ts": 100_000}])
    add_batch(right, 1, [{"k": "a", "rt": 110_000}, {"k": "a", "rt": 110_001}, {"k": "b", "rt": 95_000}])
    l_rows = times.with_event_time(stream(spark, left, "k STRING, ts BIGINT"), "ts", lateness="1 hour")
    r_rows = times.with_event_time(stream(spark, right, "k STRING, rt BIGINT"), "rt", lateness="1 hour")
    got = run(joins.interval_join(l_rows, r_rows, "k", -10_000, 10_000), tmp_path / "out")
    assert sorted((r["k"], r["rt"]) for r in got.collect()) == [("a", 90_000), ("a", 110_000), ("b", 95_000)]


def test_late_rows_are_dropped_from_windows(spark, tmp_path):
    source = f"{tmp_path}/in"
    add_batch(source, 0, [{"uid": "a", "ts": 1_000}, {"uid": "a", "ts": 600_000}])
    add_batch(source, 1, [{"uid": "a", "ts": 1_200_000}])
    add_batch(source, 2, [{"uid": "a", "ts": 2_000}, {"uid": "a", "ts": 1_800_000}])
    rows = times.with_event_time(stream(spark, source, "uid STRING, ts BIGINT"), "ts")
    got = run(state.window_partials(rows, times.EVENT_TIME, "2 minutes", ()), tmp_path / "out")
    assert sorted((r["window_start"], r["views"]) for r in got.collect()) == [(0, 1), (600_000, 1), (1_200_000, 1)]


def test_restart_reads_only_new_files(spark, tmp_path):
    source = f"{tmp_path}/in"
    add_batch(source, 0, [{"k": "a", "ts_ms": 5}])
    rows = lambda: state.increasing_only(stream(spark, source, "k STRING, ts_ms BIGINT"), "k", ttl_ms=None)
    assert run(rows(), tmp_path / "out").count() == 1
    add_batch(source, 1, [{"k": "a", "ts_ms": 4}, {"k": "a", "ts_ms": 6}])
    assert sorted(r["ts_ms"] for r in run(rows(), tmp_path / "out").collect()) == [5, 6]


def test_dimension_versions_survive_a_retried_batch(spark, tmp_path):
    path = f"{tmp_path}/dim"
    spark.createDataFrame([(1, "a")], "id INT, name STRING").write.parquet(f"{path}/version=0")
    write = files.dimension_versions(path, "id", ["name"], ["seq"])
    first = spark.createDataFrame([(2, "b", "c", 1)], "id INT, name STRING, op STRING, seq INT")
    second = spark.createDataFrame([(1, None, "d", 2)], "id INT, name STRING, op STRING, seq INT")
    for batch, changes in ((0, first), (0, first), (1, second), (1, second)):
        write(changes, batch)
    assert [tuple(r) for r in dimensions.current_version(spark, path).collect()] == [(2, "b")]
    assert dimensions.current_version(spark, path, below=2).count() == 2


def test_batch_folders_are_overwritten_on_retry(spark, tmp_path):
    write = files.batch_folders(f"{tmp_path}/out", "parquet")
    for _ in range(2):
        write(spark.range(3), 0)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_shared_folder_is_below_the_named_one(spark):
    class Named:
        conf = {"spark.checkpoint.dir": "hdfs://shared/somewhere"}

    one, two = session.shared_folder(Named), session.shared_folder(Named)
    assert one.startswith("hdfs://shared/somewhere/") and one != two
    assert not session.shared_folder(spark).startswith("hdfs:")


def test_topic_options():
    place = feeds.topic("h:1", "t", "latest")
    assert place.format == "kafka" and place.options["startingOffsets"] == "latest" and place.options["subscribe"] == "t"
    assert "kafka.acks" not in topics.options("h:1", "t")
    durable = topics.options("h:1", "t", durable=True)
    assert durable["kafka.acks"] == "all" and durable["kafka.enable.idempotence"] == "true"
    assert "topic" not in topics.options("h:1")


def test_topic_writers_are_built(spark, tmp_path):
    rows = spark.range(3)
    source = f"{tmp_path}/in"
    add_batch(source, 0, [{"k": "a"}])
    assert topics.batch(rows, "h:1", "t") is not None
    assert topics.stream(stream(spark, source, "k STRING"), "h:1", "t", f"{tmp_path}/c", durable=True) is not None
    assert files.console(stream(spark, source, "k STRING")) is not None
    assert files.stream_text(stream(spark, source, "k STRING"), f"{tmp_path}/o", f"{tmp_path}/c") is not None


def test_routed_and_upsert_rows(spark):
    rows = spark.createDataFrame([("t1", 1, "x")], "sink_table STRING, id INT, v STRING")
    assert tuple(topics.routed(rows).first()) == ("t1", '{"id":1,"v":"x"}')
    assert tuple(topics.upsert(rows.drop("sink_table"), "id").first()) == ('{"id":1}', '{"id":1,"v":"x"}')


def test_text_feed_and_snapshot(spark, tmp_path):
    path = f"{tmp_path}/feed"
    users = spark.createDataFrame([("1", "n")], "id STRING, name STRING")
    feeds.write_snapshot(users, "shop", "user_info", F.lit(1), path)
    with open(f"{path}/extra.txt", "w") as out:
        out.write('{"after":{"id":"2"},"source":{"table":"user_info"},"op":"c","ts_ms":2}\nbroken\n')
    changes = feeds.change_feed(spark, feeds.folder(path), {"user_info": users}, "shop")
    assert sorted((r["op"], r["ts_ms"]) for r in changes.collect()) == [("c", 2), ("r", 0), ("r", 1)]
    feeds.feed_view("changes_view", changes)
    assert spark.sql("SELECT count(*) FROM changes_view WHERE op = 'r'").first()[0] == 2
    streamed = run(feeds.text_feed(spark, feeds.folder(path), streaming=True), tmp_path / "out")
    assert streamed.count() == 3


def test_json_lines_modified_after(spark, tmp_path):
    source = f"{tmp_path}/in"
    add_batch(source, 0, [{"k": "old"}])
    add_batch(source, 90_000, [{"k": "new"}])
    got = feeds.json_lines(spark, source, "k STRING", modified_after="2023-11-15T00:00:00")
    assert [r["k"] for r in got.collect()] == ["new"]


def test_dimension_readers(spark, tmp_path):
    spark.createDataFrame([(1, "n")], "base_id INT, base_category_name STRING").write.parquet(f"{tmp_path}/d")
    assert dimensions.from_files(spark, f"{tmp_path}/d", camel_case=True).columns == ["baseId", "baseCategoryName"]
    rows = dimensions.from_query(spark, "", {"path": f"{tmp_path}/d"}, camel_case=True, format="parquet")
    assert rows.first()["baseCategoryName"] == "n"
    dimensions.dimension_view("dim_view", rows)
    assert spark.sql("SELECT baseId FROM dim_view").first()[0] == 1


@pytest.mark.parametrize("partitioned", [True, False])
def test_layout(spark, tmp_path, partitioned):
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("dt"))
    files.write_table(rows, files.Layout(f"{tmp_path}/t", partitioned, field="dt"))
    assert os.path.isdir(f"{tmp_path}/t/dt=1") is partitioned
    assert spark.read.parquet(f"{tmp_path}/t").count() == 100


def test_dimension_is_read_again_for_each_batch(spark, tmp_path):
    source, dim = f"{tmp_path}/in", f"{tmp_path}/dim"
    add_batch(source, 0, [{"k": "a"}])
    add_batch(source, 1, [{"k": "b"}])
    seen = []

    def read_dim():
        seen.append(1)
        return spark.createDataFrame([("a", f"v{len(seen)}"), ("b", f"v{len(seen)}")], "k STRING, name STRING")

    write = runs.enriched(read_dim, "k", files.batch_folders(dim, "parquet"), prefix="d_")
    rows = stream(spark, source, "k STRING")
    writer = rows.writeStream.option("checkpointLocation", f"{tmp_path}/c").foreachBatch(write)
    runs.start(writer, spark, trigger=None).awaitTermination()
    got = spark.read.parquet(dim).select("k", "d_name").collect()
    assert sorted(map(tuple, got)) == [("a", "v1"), ("b", "v2")]


def test_many_times_of_one_key_in_one_batch(spark, tmp_path, monkeypatch):
    import random

    monkeypatch.setattr(state, "HELD_TIMES", 20_000)
    order = list(range(25_000)) + list(range(0, 25_000, 10))
    random.Random(1).shuffle(order)
    add_batch(f"{tmp_path}/in", 0, [{"k": "x", "ts_ms": t} for t in order])
    rows = stream(spark, f"{tmp_path}/in", "k STRING, ts_ms BIGINT")
    got = run(state.increasing_only(rows, "k", ttl_ms=None), tmp_path / "out")
    assert got.count() == got.distinct().count() == 25_000


def test_many_windows_of_one_user_in_one_batch(spark, tmp_path):
    import random

    order = list(range(15_000))
    random.Random(1).shuffle(order)
    add_batch(f"{tmp_path}/in", 0, [{"uid": "u", "ts": t * 120_000, "os": "i"} for t in order])
    rows = stream(spark, f"{tmp_path}/in", "uid STRING, ts BIGINT, os STRING")
    got = run(state.running_sets(rows, "uid", "ts", ("os",), ("ts",), ttl_ms=None), tmp_path / "out")
    assert got.filter("pv = ts / 120000 + 1").count() == 15_000


def test_copies_of_a_page_count_once_over_batches(spark, tmp_path):
    source = f"{tmp_path}/in"
    page = {"uid": "u", "ts": 1000, "deviceInfo": {"os": "iOS", "ch": "c", "md": "m", "ba": "b"}, "search_item": "k"}
    add_batch(source, 0, [page, page, page])
    add_batch(source, 1, [page, {**page, "ts": 2000}])
    add_batch(source, 2, [{**page, "uid": "other", "ts": 900_000}])
    schema = "uid STRING, ts BIGINT, deviceInfo STRUCT<os: STRING, ch: STRING, md: STRING, ba: STRING>, search_item STRING"
    got = run(flows.page_snapshots(stream(spark, source, schema), ttl_ms=None), tmp_path / "out")
    assert [(r.uid, r.pv) for r in got.filter("uid = 'u'").collect()] == [("u", 2)]


def test_stream_looks_up_a_large_dimension(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batch_joins, "BROADCAST_ROWS", 0)
    add_batch(f"{tmp_path}/in", 0, [{"k": "a"}, {"k": "b"}, {"k": None}])
    dim = spark.createDataFrame([("a", "x")], "k STRING, name STRING")
    rows = batch_joins.lookup_join(stream(spark, f"{tmp_path}/in", "k STRING"), dim, "k")
    assert sorted((str(r.k), str(r.name)) for r in run(rows, tmp_path / "out").collect()) == [("None", "None"), ("a", "x"), ("b", "None")]


def test_closing_rows_of_a_window_are_equal(spark):
    """What was seen is kept in state, where pages of one window add a single row for the closing user."""
    device = "named_struct('ar', ar, 'ba', ba, 'ch', ar, 'md', ba, 'os', ar, 'uid', uid, 'vc', ba)"
    data = [("u", 1_704_067_200_000 + i, f"a{i}", None if i % 2 else f"b{i}", f"s{i}") for i in range(50)]
    pages = spark.createDataFrame(data, "uid string, ts bigint, ar string, ba string, search_item string")
    pages = pages.selectExpr("uid", "ts", f"{device} AS deviceInfo", "search_item")
    closed = with_closing_rows(pages)
    assert closed.dtypes == pages.dtypes
    assert closed.filter("uid = 'u'").exceptAll(pages).isEmpty() and closed.filter("uid = 'u'").count() == 50
    (later,) = closed.filter("uid != 'u'").distinct().collect()
    assert later.ts - 3_000 >= 1_704_067_200_000 + 2 * 60_000
