"""Totals over intervals and counts of distinct values, against plain loops; hot keys included."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, running


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_totals_are_those_of_all_pairs(spark, hot_rows):
    """Repeated rows, missing keys, times and values, times on both bounds, two sides of different reach."""
    rng = random.Random(4)
    key = lambda: rng.choices(["a", "b", "c", None], [8, 2, 1, 1])[0]
    time = lambda: rng.choice([None, *range(0, 60)])
    left = [(key(), time(), rng.choice("xy")) for _ in range(120)]
    one = [(key(), time(), rng.choice([None, 0.1, 0.2, 1e6])) for _ in range(150)]
    two = [(key(), time(), rng.choice([-0.3, 7.5])) for _ in range(80)]
    l_rows = spark.createDataFrame(left, "k STRING, ts BIGINT, tag STRING")
    sides = [
        joins.Within(spark.createDataFrame(one, "k STRING, at BIGINT, v DOUBLE"), -5, 9, "n", {"v_sum": F.col("v"), "twice": F.col("v") * 2}, "at"),
        joins.Within(spark.createDataFrame(two, "k STRING, at BIGINT, w DOUBLE"), 0, 0, "m", {"w_sum": F.col("w")}, "at"),
    ]

    def near(row, rows, low, high):
        return [r for r in rows if None not in (row[0], row[1], r[0], r[1]) and r[0] == row[0] and low <= r[1] - row[1] <= high]

    total = lambda rows, times=1: float(sum(Decimal(str(r[2])) * times for r in rows if r[2] is not None))
    want = []
    for row in left:
        p, q = near(row, one, -5, 9), near(row, two, 0, 0)
        want.append((*row, len(p), total(p), total(p, 2), len(q), total(q)))
    got = joins.totals_within(l_rows, sides, "k", "ts", hot_rows)
    assert got.columns == ["k", "ts", "tag", "n", "v_sum", "twice", "m", "w_sum"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_totals_form_no_pairs(spark):
    """A thousand rows of one key on each side, all in reach of each other."""
    rows = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("ts"), (F.col("id") * 0.5).alias("v"))

    got = joins.totals_within(rows.select("k", "ts"), [joins.Within(rows.withColumnRenamed("ts", "at"), -2000, 2000, "n", {"s": F.col("v")}, "at")], "k", "ts")
    assert "Join" not in plan(got)
    assert {(r.n, r.s) for r in got.collect()} == {(1000, 249750.0)} and got.count() == 1000


def test_totals_of_nothing(spark):
    left = spark.createDataFrame([("a", 1)], "k STRING, ts BIGINT")
    none = spark.createDataFrame([], "k STRING, at BIGINT, v DOUBLE")
    side = joins.Within(none, -1, 1, "n", {"s": F.col("v")}, "at")
    assert [tuple(r) for r in joins.totals_within(left, [side], "k", "ts").collect()] == [("a", 1, 0, 0.0)]
    assert joins.totals_within(left.limit(0), [side], "k", "ts").count() == 0


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_distinct_counts_and_new_values(spark, hot_rows):
    rng = random.Random(9)
    rows = [(rng.choices(["a", "b", None], [8, 2, 1])[0], rng.choice([None, 0, 0, *range(30)]), i, rng.choice([None, "x", "y", str(i % 40)]), i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "k STRING, ts BIGINT, id INT, v STRING, w INT").repartition(3)
    seen, want = {}, []
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        values, numbers = seen.setdefault(row[0], (set(), set()))
        new_v, new_w = row[3] is not None and row[3] not in values, row[4] not in numbers
        values |= {row[3]} - {None}
        numbers.add(row[4])
        want.append((*row, len(values), len(numbers), new_v, new_w))
    got = running.with_distinct_counts(df, "k", "ts", ["id"], ["v", "w"], hot_rows)
    assert got.columns == ["k", "ts", "id", "v", "w", "v_count", "w_count", "v_new", "w_new"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_a_hundred_thousand_values_of_one_key(spark):
    """Each row has a value of its own; with lists the output would be five thousand million values."""
    rows = spark.range(100_000).select(F.lit("u").alias("k"), F.col("id").alias("ts"), F.col("id").cast("string").alias("v"))
    got = running.with_distinct_counts(rows, "k", "ts", [], ["v"], hot_rows=10_000)
    assert got.filter("v_count = ts + 1 AND v_new").count() == 100_000
