"""Operators under a hot key, with the split forced on, against brute force."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, dedup, feed_joins, joins, running, skew
from tidemark.functions import fixed_values as V

MANY = 600


def skewed(seed, n=MANY, span=5_000):
    """Rows of which half belong to one key; times repeat."""
    pick = random.Random(seed)
    return [
        ("hot" if pick.random() < 0.5 else f"u{pick.randrange(40)}", pick.randrange(span), i, pick.choice("abcdef"))
        for i in range(n)
    ]


def as_set(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame(skewed(1), "uid STRING, ts_ms BIGINT, n INT, v STRING").cache()


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame(skewed(2), "uid STRING, _right_ts BIGINT, m INT, w STRING").cache()


@pytest.fixture(scope="module")
def con(left, right):
    c = duckdb.connect()
    for name, df in (("l", left), ("r", right)):
        c.register(name, df.toPandas())
    return c


def test_hot_keys_are_found_hottest_first(left):
    found = skew.hot_keys(left, "uid", 50).collect()
    assert [r["uid"] for r in found] == ["hot"]
    assert skew.find_hot(left, "uid", 10_000) is None


def test_hot_keys_in_a_sample(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert [r["k"] for r in skew.hot_keys(rows, "k", 10_000).collect()] == ["hot"]


def test_chunks_follow_the_order(left):
    ranges = skew.find_hot_ranges(left, "uid", "ts_ms", 50)
    chunked = skew.with_chunk(left, ranges, "uid", "ts_ms")
    hot = chunked.filter("uid = 'hot'").groupBy("_chunk").agg(F.min("ts_ms"), F.max("ts_ms"), F.count("*")).orderBy("_chunk").collect()
    assert len(hot) > 10
    assert all(a[2] < b[1] for a, b in zip(hot, hot[1:]))
    assert chunked.filter("uid <> 'hot' AND _chunk <> 0").count() == 0


def test_far_positions_and_bursts_do_not_fill_one_chunk(spark):
    burst = [("hot", 5_000_000 + i) for i in range(4_000)]
    rows = [("hot", None), ("hot", 0), ("hot", 10**15)] + [("hot", 10**9 + 1000 * i) for i in range(4_000)] + burst
    df = spark.createDataFrame(rows, "uid STRING, ts_ms BIGINT")
    ranges = skew.find_hot_ranges(df, "uid", "ts_ms", 1_000)
    chunks = skew.with_chunk(df, ranges, "uid", "ts_ms").groupBy("_chunk").agg(F.min("ts_ms"), F.max("ts_ms"), F.count("*")).orderBy("_chunk").collect()
    assert max(c[3] for c in chunks) <= 2 * 1_000 and chunks[0][0] == -1 and chunks[0][3] == 1
    assert all(a[2] < b[1] for a, b in zip(chunks[1:], chunks[2:]))


def test_all_hot_keys_are_found_and_cut_by_their_rows(spark):
    rows = spark.range(300_000).select((F.col("id") % 1_500).alias("k")).union(spark.range(20_000).select(F.lit(7).cast("bigint")))
    found = skew.find_hot(rows, "k", 200).collect()
    assert len(found) == 1_500
    parts = {r["k"]: r["_parts"] for r in found}
    assert parts[7] == 404 and parts[8] == 4


@pytest.mark.parametrize("hot_rows", [50, 10_000])
def test_running_values(left, con, hot_rows):
    got = running.with_running(
        left, "uid", "ts_ms", ["n"],
        {
            "c": running.running_count(), "s": running.running_set(F.col("v")),
            "e": running.earlier_max(F.col("n")), "k": running.last_known(F.when(F.col("v") == "a", F.col("n")), ["ts_ms", "n"]),
        },
        hot_rows,
    ).withColumn("s", F.array_join(F.array_sort("s"), ","))
    want = con.sql("""
        SELECT uid, n, count(*) OVER w, array_to_string(list_sort(list_distinct(array_agg(v) OVER w)), ','),
               max(n) OVER (PARTITION BY uid ORDER BY ts_ms, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               last_value(CASE WHEN v = 'a' THEN n END IGNORE NULLS) OVER w
        FROM l WINDOW w AS (PARTITION BY uid ORDER BY ts_ms, n ROWS UNBOUNDED PRECEDING)""").fetchall()
    assert as_set(got, "uid", "n", "c", "s", "e", "k") == sorted(want, key=repr)


@pytest.mark.parametrize("hot_rows", [50, 10_000])
def test_increasing_only(left, con, hot_rows):
    got = dedup.increasing_only(left, "uid", "ts_ms", "n", hot_rows=hot_rows)
    want = con.sql("""SELECT uid, ts_ms, n FROM (SELECT *, max(ts_ms) OVER (PARTITION BY uid ORDER BY n
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM l) WHERE seen IS NULL OR ts_ms > seen""").fetchall()
    assert as_set(got, "uid", "ts_ms", "n") == sorted(want, key=repr)


@pytest.mark.parametrize("hot_rows", [50, 10_000])
@pytest.mark.parametrize("lower,upper", [(-100, 100), (0, 7), (-300, -20), (-5000, 5000)])
@pytest.mark.parametrize("sides", ["right", "left", "both"])
def test_interval_join(left, right, con, hot_rows, lower, upper, sides):
    """``sides`` says where the hot key is looked for; u1 is hot on the left in every case but the first."""
    some = lambda df, *keys: df.filter(F.col("uid").isin(*keys)).withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(50))))

    def hot_in(df):
        if df is left:
            return {"right": None, "left": some(left, "hot", "u1"), "both": some(left, "hot", "u1")}[sides]
        return {"right": None, "left": some(right, "nobody"), "both": None}[sides]

    got = joins.hot_interval_join(
        left, right, "uid", lower, upper, hot_rows=hot_rows, hot_from=hot_in(right), left_hot_from=hot_in(left)
    )
    want = con.sql(f"""SELECT l.n, r.m FROM l JOIN r ON l.uid = r.uid
        AND r._right_ts BETWEEN l.ts_ms + {lower} AND l.ts_ms + {upper}""").fetchall()
    assert as_set(got, "n", "m") == sorted(want, key=repr)


def test_interval_bounds_are_inclusive(spark):
    left = spark.createDataFrame([("a", 100)], "k STRING, ts_ms BIGINT")
    right = spark.createDataFrame([("a", t) for t in (89, 90, 110, 111)], "k STRING, _right_ts BIGINT")
    for hot_rows in (1, 1000):
        got = joins.hot_interval_join(left, right, "k", -10, 10, hot_rows=hot_rows)
        assert sorted(r["_right_ts"] for r in got.collect()) == [90, 110]


@pytest.mark.parametrize("hot_rows", [50, 10_000])
@pytest.mark.parametrize("lower,upper", [(-100, 100), (-5, 0), (10, 60)])
def test_latest_within(left, right, con, hot_rows, lower, upper):
    sides = {"a": (right, "_right_ts", lower, upper), "b": (right.filter("w = 'a'"), "_right_ts", -50, 500)}
    got = joins.latest_within(left, sides, "uid", hot_rows=hot_rows).select(
        "n", F.col("a.m").alias("a"), F.col("b.m").alias("b")
    )
    best = lambda lo, hi, extra: f"""(SELECT m FROM r WHERE r.uid = l.uid {extra}
        AND r._right_ts BETWEEN l.ts_ms + {lo} AND l.ts_ms + {hi} ORDER BY r._right_ts DESC, m DESC LIMIT 1)"""  # noqa: E731
    want = con.sql(f"SELECT n, {best(lower, upper, '')}, {best(-50, 500, chr(65) + chr(78) + chr(68) + chr(32) + 'w = ' + repr('a'))} FROM l").fetchall()
    assert as_set(got, "n", "a", "b") == sorted(want, key=repr)


@pytest.mark.parametrize("limit,hot_rows", [(1000, 50), (0, 50), (0, 10_000)])
def test_lookup(left, spark, limit, hot_rows):
    dim = spark.createDataFrame([("hot", "H"), ("u1", "one")], "uid STRING, name STRING")
    left = left.unionByName(left.limit(20).withColumn("uid", F.lit(None).cast("string")))
    got = joins.lookup_join(left, dim, "uid", prefix="dim_", max_broadcast_rows=limit, hot_rows=hot_rows)
    assert got.count() == MANY + 20
    names = {"hot": "H", "u1": "one"}
    assert all(r["dim_name"] == names.get(r["uid"]) for r in got.collect())


@pytest.mark.parametrize("hot_rows", [50, 10_000])
def test_keep_left_join(right, spark, hot_rows):
    heads = spark.createDataFrame([("hot", 1), ("u1", 2), ("nobody", 3)], "uid STRING, h INT")
    got = joins.keep_left_join(heads, right, "uid", hot_rows=hot_rows)
    want = heads.join(right, "uid", "left")
    columns = sorted(want.columns)
    assert as_set(got, *columns) == as_set(want, *columns)


def feeds(spark, seed):
    pick = random.Random(seed)
    who = lambda: "hot" if pick.random() < 0.5 else f"u{pick.randrange(15)}"
    score = lambda: [round(pick.randrange(10) / 100, 2) for _ in V.BUCKETS]

    def frame(prefixes, extra):
        names = [f"{p}_{b}" for p in prefixes for b in V.BUCKETS]
        data = [(who(), pick.randrange(2000), str(i), *[s for _ in prefixes for s in score()]) for i in range(150)]
        return spark.createDataFrame(data, ", ".join(["uid STRING", "ts_ms BIGINT", f"{extra} STRING", *[f"{n} DOUBLE" for n in names]]))

    return frame(["search", "device"], "page_id"), frame(["pay_time", "b1name", "tname", "amount"], "detail_id")


@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_latest_labels_are_the_last_pairs(spark, hot_rows):
    base2, base4 = feeds(spark, 5)
    base2 = base2.dropDuplicates(["uid", "ts_ms"])
    pairs = feed_joins.age_level_pairs(base2, base4, 60, hot_rows).collect()
    got = {r["uid"]: (r["ts_ms"], r["ageLevel"]) for r in feed_joins.latest_age_levels(base2, base4, 60, hot_rows).collect()}
    con = duckdb.connect()
    con.register("p", base2.toPandas())
    con.register("o", base4.toPandas())
    total = "[" + ", ".join(" + ".join(f'"{x}_{b}"' for x in ("search", "device", "pay_time", "b1name", "tname", "amount")) for b in V.BUCKETS) + "]"
    rows = con.sql(f"""SELECT p.uid, p.ts_ms, {total}, row_number() OVER (PARTITION BY p.uid ORDER BY p.ts_ms DESC, o.ts_ms DESC, detail_id DESC)
        FROM p JOIN o ON p.uid = o.uid AND o.ts_ms BETWEEN p.ts_ms - 60 AND p.ts_ms + 60""").fetchall()
    label = lambda scores: V.BUCKETS[scores.index(max(scores))]
    assert got == {u: (t, label(s)) for u, t, s, rank in rows if rank == 1}
    assert sorted((r["uid"], r["ts_ms"], r["ageLevel"]) for r in pairs) == sorted((u, t, label(s)) for u, t, s, _ in rows)


def test_page_snapshots_equal_running_rows(spark):
    pick = random.Random(9)
    data = [
        ("hot" if i % 2 else f"u{pick.randrange(5)}", pick.randrange(3000), i, pick.choice(["iOS", "Android"]), pick.choice("xyz"),
         pick.choice(["m1", "m2", None]), pick.choice("pq"), pick.choice(["k1", "k2", None]))
        for i in range(400)
    ]
    pages = spark.createDataFrame(data, "uid STRING, ts BIGINT, n INT, os STRING, ch STRING, md STRING, ba STRING, search_item STRING").select(
        "uid", "ts", "n", F.struct("os", "ch", "md", "ba").alias("deviceInfo"), "search_item"
    )
    every = running.page_statistics(pages, ["n"], hot_rows=30)
    last = running.last_per_window(every, "uid", "ts", 120, ["n"]).drop("n")
    for hot_rows in (30, 10_000):
        fused = running.page_window_snapshots(pages, 120, hot_rows)
        columns = sorted(fused.columns)
        assert as_set(fused, *columns) == as_set(last, *columns)
    plain = running.page_statistics(pages, ["n"], hot_rows=10_000)
    assert as_set(every, *plain.columns) == as_set(plain, *plain.columns)


def test_apply_changes(spark):
    snapshot = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id INT, name STRING, kind STRING")
    changes = spark.createDataFrame(
        [(1, 1, "u", "a2", None), (2, 2, "d", None, None), (4, 3, "c", "new", None), (3, 4, "d", None, None), (3, 5, "c", "again", None)],
        "id INT, seq INT, op STRING, name STRING, kind STRING",
    )
    got = cdc.apply_changes(snapshot, changes, "id", ["name", "kind"], ["seq"])
    assert sorted(map(tuple, got.collect())) == [(1, "a2", "x"), (3, "again", None), (4, "new", None)]


def test_copies_collapse(spark):
    copies = spark.createDataFrame([("a", 1, 5)] * 500 + [("a", 1, 6), ("b", 1, 5)], "k STRING, ts_ms INT, x INT")
    assert dedup.full_row(copies).count() == 3
    assert as_set(dedup.by_key_and_time(copies, "k"), "k", "ts_ms", "x") == [("a", 1, 5), ("b", 1, 5)]


@pytest.mark.parametrize("kind", ["number", "text"])
def test_many_rows_of_one_position_are_cut_by_the_tie(spark, kind):
    """A third of the rows have no real time (0); ties are unique, and some are null."""
    pick = random.Random(12)
    ties = pick.sample(range(3000), 2000)
    tie = lambda i: None if i % 50 == 0 else i if kind == "number" else f"n{i:05d}" if i % 2 else f"ñ{i}"
    rows = [("hot" if i % 10 else "u", 0 if i % 3 == 0 else pick.choice([None, -5, *range(1, 400)]), tie(t), i) for i, t in enumerate(ties)]
    df = spark.createDataFrame(rows, f"k STRING, at BIGINT, tie {'INT' if kind == 'number' else 'STRING'}, n INT").repartition(4)
    ranges = skew.find_hot_ranges(df, "k", "at", 100)
    heavy = skew.find_heavy(df, ranges, "k", "at", "tie", 100)
    chunks = skew.with_tie_chunk(skew.with_chunk(df, ranges, "k", "at"), heavy, "k", "at", "tie").filter("k = 'hot' AND at = 0")
    assert chunks.select("_chunk").distinct().count() > 10
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, (r[2] or 0) if kind == "number" else (r[2] or "").encode(), r[3])
    want, seen = [], {}
    for r in sorted(rows, key=order):
        seen[r[0]] = seen.get(r[0], 0) + r[3]
        want.append((*r, seen[r[0]]))
    got = running.with_running(df, "k", "at", ["tie", "n"], {"total": running.running_sum(F.col("n"))}, 100)
    assert as_set(got, "k", "at", "tie", "n", "total") == sorted(want, key=repr)
