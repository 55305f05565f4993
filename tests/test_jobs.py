"""The whole chain on text feeds, in batch and as streams: capture, feeds, labels, merge."""

import json
import os

from pyspark.sql import functions as F

from tidemark.operators import cdc, dimensions, feed_joins
from tidemark.plans import flows, jobs
from tidemark.sources import feeds

DAY = 86_400_000
T0 = 1_704_067_200_000


def change(table, after, ts, op="c"):
    return json.dumps({"before": None, "after": after, "source": {"db": "shop", "table": table}, "op": op, "ts_ms": ts})


def lines():
    rows = []
    for uid in range(1, 5):
        rows.append(change("user_info", {"id": str(uid), "name": f"n{uid}", "birthday": 9000 + uid, "gender": None}, T0 + uid))
        rows.append(change("user_info_sup_msg", {"uid": str(uid), "height": "170", "weight": "60"}, T0 + uid // 3 * 2 * DAY))
        for n in range(2):
            order, at = f"{uid}{n}", T0 + n * DAY
            rows.append(change("order_info", {"id": order, "user_id": str(uid), "create_time": at, "total_amount": 500.0 * uid}, at))
            detail = {"id": order + "9", "order_id": order, "sku_id": uid % 2, "sku_num": 1, "order_price": "5"}
            rows.append(change("order_detail", detail, at + 3_600_000))
            rows.append(change("order_detail", detail, at + 3_600_000))
    rows.append(change("order_info", {"id": "gone"}, T0, op="d"))
    rows.append("not json")
    return rows


def pages():
    rows = [
        {"common": {"uid": str(uid), "os": "iOS 13" if uid % 2 else "Android 11", "ch": "web", "md": "m", "ba": "b"},
         "page": {"item": "shoe", "item_type": "keyword"}, "ts": T0 + n * 60_000}
        for uid in range(1, 5) for n in range(6)
    ]
    rows.append({"common": {"uid": "far", "os": "iOS 13"}, "ts": T0 + DAY})
    return [json.dumps(r) for r in rows]


def put(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/0.txt", "w") as out:
        out.write("\n".join(rows) + "\n")


def dims(spark):
    sku = spark.createDataFrame([("0", "s", "c", "苹果"), ("1", "s", "c", "TCL")], "skuid STRING, spuid STRING, c3id STRING, tname STRING")
    categories = spark.createDataFrame([("c", "手机")], "id STRING, b1name STRING")
    names = spark.createDataFrame([(1, "shoe", "手机")], "id INT, b3name STRING, b1name STRING")
    comparison = spark.createDataFrame([(1, "手机", "科技与数码")], "id INT, category_name STRING, search_category STRING")
    return jobs.Dimensions(sku, categories, dimensions.keyword_categories(names, comparison))


COLUMNS = ("uid", "uname", "gender", "birthday", "age", "zodiac_sign", "height", "weight", "ageLevel")


def test_streams_give_the_labels_of_the_batch_jobs(spark, tmp_path):
    put(f"{tmp_path}/changes", lines())
    put(f"{tmp_path}/pages", pages())
    read = lambda name, streaming=False: feeds.text_feed(spark, feeds.folder(f"{tmp_path}/{name}"), streaming)

    batch = jobs.Stages(f"{tmp_path}/batch")
    jobs.write_feeds(
        cdc.parse_envelope(read("changes")), cdc.parse_page_log(read("pages")), dims(spark), batch, "2025-05-12"
    )
    want = jobs.write_labels(spark, batch).select(*COLUMNS).collect()
    assert len(want) == 4
    assert {r["gender"] for r in want} == {"home"}

    stages = jobs.Stages(f"{tmp_path}/stream")
    jobs.start_capture(spark, feeds.folder(f"{tmp_path}/changes"), stages, None).awaitTermination()
    captured = feeds.text_feed(spark, feeds.folder(stages.rows("changes")), streaming=True)
    for started in jobs.start_feeds(captured, read("pages", True), dims(spark), stages, "2025-05-12", None, ttl_ms=None).values():
        started.awaitTermination()
    jobs.start_labels(spark, stages, None).awaitTermination()
    rows = spark.read.parquet(stages.rows("labels"))
    newest = rows.groupBy("uid").agg(F.max_by(F.struct(*COLUMNS), F.struct("page_ts_ms", "order_ts_ms")).alias("r"))
    got = newest.select("r.*").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))

    names = spark.createDataFrame([(0, "性价比", "苹果"), (1, "学习与发展", "联想")], "sku_id BIGINT, bcname STRING, btname STRING")
    other = spark.createDataFrame([("10", "长粒香", "科技与数码")], "order_id STRING, base_trademark_name STRING, base_category_name STRING")
    jobs.start_user_sums(captured, names, other, stages, "2025-05-12", None).awaitTermination()
    summed = spark.read.parquet(stages.rows("user_sums"))
    envelopes = cdc.parse_envelope(read("changes"))
    table = lambda name: cdc.table(envelopes, name)
    sums = flows.order_sums(table("order_info"), table("order_detail"), names, other)
    users = feed_joins.users_with_order_sums(
        flows.user_feed(table("user_info"), table("user_info_sup_msg"), "2025-05-12", DAY), sums
    )
    pairs = feed_joins.users_with_page_scores(users, spark.read.parquet(batch.rows("base2")))
    assert summed.count() == summed.select("uid").distinct().count() == 2
    assert summed.select(*pairs.columns).exceptAll(pairs).count() == 0
    latest = flows.user_sums(
        flows.user_feed(table("user_info"), table("user_info_sup_msg"), "2025-05-12", DAY), sums,
        spark.read.parquet(batch.rows("base2")),
    )
    assert latest.select(*pairs.columns).exceptAll(pairs).count() == 0 and latest.count() == 2

    base4 = spark.read.parquet(stages.rows("base4"))
    assert base4.count() == spark.read.parquet(batch.rows("base4")).count() == 8
    merged = jobs.merge_feeds({
        n: spark.read.parquet(stages.rows(n)).select(F.to_json(F.struct("uid")).alias("value")) for n in ("base4", "base6")
    })
    assert {r["source"]: r["count"] for r in merged.groupBy("source").count().collect()} == {"base4": 8, "base6": 4}
