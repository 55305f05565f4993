"""Running aggregates per key: one output row per input row, in order.

A running aggregate is a window function, and a plain window puts each key in one task. Here the rows of
a hot key are cut into chunks along the order; each chunk is its own window group, and what came before a
chunk is added from a small table of per-chunk totals. Other keys stay in one chunk, so their rows are
shuffled once and the totals table has no row for them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.text import sorted_csv
from tidemark.operators import skew


@dataclass(frozen=True)
class Running:
    """How to compute one running value inside a chunk, per chunk, over chunks, and put together."""

    inside: Callable[[WindowSpec], Column]
    total: Column
    over_totals: Callable[[Column, WindowSpec], Column]
    together: Callable[[Column, Column], Column]


def running_count() -> Running:
    return Running(
        inside=lambda w: F.count("*").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        total=F.count("*"),
        over_totals=lambda total, w: F.sum(total).over(w),
        together=lambda before, here: F.coalesce(before, F.lit(0)) + here,
    )


def running_sum(value: Column) -> Running:
    return Running(
        inside=lambda w: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        total=F.sum(value),
        over_totals=lambda total, w: F.sum(total).over(w),
        together=lambda before, here: F.coalesce(before, F.lit(0)) + here,
    )


def running_set(value: Column) -> Running:
    """Distinct non-null values so far, unsorted."""
    return Running(
        inside=lambda w: F.collect_set(value).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        total=F.collect_set(value),
        over_totals=lambda total, w: F.array_distinct(F.flatten(F.collect_list(total).over(w))),
        together=lambda before, here: F.when(before.isNull(), here).otherwise(F.array_union(before, here)),
    )


def earlier_max(value: Column) -> Running:
    """Largest value of the rows before this one."""
    return Running(
        inside=lambda w: F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        total=F.max(value),
        over_totals=lambda total, w: F.max(total).over(w),
        together=lambda before, here: F.greatest(before, here),
    )


def latest_time(time: str) -> Running:
    return Running(
        inside=lambda w: F.max(time).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        total=F.max(time),
        over_totals=lambda total, w: F.max(total).over(w),
        together=lambda before, here: F.greatest(before, here),
    )


def last_known(value: Column, order: Sequence[str]) -> Running:
    """Latest non-null value so far, this row included."""
    return Running(
        inside=lambda w: F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        total=F.max_by(value, F.when(value.isNotNull(), F.struct(*order))),
        over_totals=lambda total, w: F.last(total, ignorenulls=True).over(w),
        together=lambda before, here: F.coalesce(here, before),
    )


def last_of_position(position: str) -> Running:
    """Whether the next row of the key has another position. Only for positions with few rows, which are never split."""
    return Running(
        inside=lambda w: F.coalesce(F.lead(position).over(w) != F.col(position), F.lit(True)),
        total=F.count("*"),
        over_totals=lambda total, w: F.sum(total).over(w),
        together=lambda before, here: here,
    )


def with_running(
    df: DataFrame,
    key: str,
    position: str,
    ties: Sequence[str],
    columns: dict[str, Running],
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
    cut_ties: bool = True,
) -> DataFrame:
    """Add running ``columns`` per ``key``, in the order of ``position`` (a number) and then ``ties``.

    ``hot_from`` is a cheaper table with ``key`` and ``position`` to look for hot keys in. Many rows of one position are cut
    by the first of the ties, if that is a whole number or text, unless ``cut_ties`` is off. Rows with their chunks are made once and kept in the shared
    folder, as both the rows and the totals of earlier chunks come from them.
    """
    ranges = skew.find_hot_ranges(df if hot_from is None else hot_from, key, position, hot_rows)
    if ranges is None:
        in_key = Window.partitionBy(key).orderBy(position, *ties)
        return df.select("*", *[r.inside(in_key).alias(n) for n, r in columns.items()])

    chunked = skew.with_chunk(df, ranges, key, position)
    heavy = skew.find_heavy(df, ranges, key, position, ties[0], hot_rows, hot_from) if ties and cut_ties else None
    if heavy is not None:
        chunked = skew.with_tie_chunk(chunked, heavy, key, position, ties[0])
    chunked = session.stored(chunked)
    in_chunk = Window.partitionBy(key, "_chunk").orderBy(position, *ties)
    inside = chunked.select("*", *[r.inside(in_chunk).alias(f"_in_{n}") for n, r in columns.items()])
    hot_only = chunked.join(F.broadcast(ranges.select(key)), key, "left_semi")
    totals = hot_only.groupBy(key, "_chunk").agg(*[r.total.alias(f"_total_{n}") for n, r in columns.items()])
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        key,
        "_chunk",
        *[r.over_totals(F.col(f"_total_{n}"), earlier).alias(f"_before_{n}") for n, r in columns.items()],
    )
    return inside.join(before, [key, "_chunk"], "left").select(
        *df.columns,
        *[r.together(F.col(f"_before_{n}"), F.col(f"_in_{n}")).alias(n) for n, r in columns.items()],
    )


def with_distinct_counts(
    df: DataFrame, key: str, position: str, ties: Sequence[str], fields: Sequence[str], hot_rows: int | None = None,
    hot_from: DataFrame | None = None, suffix: str = "_count", new: str = "_new",
) -> DataFrame:
    """Add per field the number of distinct non-null values so far, and whether the row's value is new.

    A value counts once, at its first row. First rows come from one aggregate over all fields, combined before the shuffle,
    and the counts are running sums over them, so neither work nor output grows with the values that a key already has.
    Lists of the values, where asked for, are the new ones in order. Rows of one position and equal ties are one place.
    """
    place = F.struct(position, *ties)
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f).cast("string").alias("value")) for i, f in enumerate(fields)]))
    firsts = (
        df.select(key, place.alias("_place"), values.alias("_v")).filter(F.col("_v.value").isNotNull())
        .groupBy(key, "_v").agg(F.min("_place").alias("_place"))
        # Of values that are first at one place only the number counts.
        .groupBy(key, "_place").agg(*[F.count(F.when(F.col("_v.i") == i, 1)).alias(f"_first_{i}") for i in range(len(fields))])
    )
    whole = F.struct(*df.columns)
    nothing = F.lit(None).cast(df.select(whole.alias("w")).schema["w"].dataType)
    at = [position, *ties]
    events = firsts.select(key, *[F.col(f"_place.{c}").alias(c) for c in at], F.lit(0).alias("_kind"), nothing.alias("_row"),
                           *[f"_first_{i}" for i in range(len(fields))])
    rows = df.select(key, *at, F.lit(1).alias("_kind"), whole.alias("_row"),
                     *[F.lit(0).cast("bigint").alias(f"_first_{i}") for i in range(len(fields))])
    columns = {f"_n_{i}": running_sum(F.col(f"_first_{i}")) for i in range(len(fields))}
    # Whether a value is new: the sum before this place's own event is smaller.
    columns |= {f"_here_{i}": last_known(F.when(F.col("_kind") == 0, F.struct(*at, f"_first_{i}")), [*at, "_kind"]) for i in range(len(fields))}
    done = with_running(events.unionByName(rows), key, position, [*ties, "_kind"], columns, hot_rows, hot_from)
    here = lambda i: F.struct(*[F.col(f"_here_{i}.{c}") for c in at]).eqNullSafe(F.struct(*at)) & (F.col(f"_here_{i}._first_{i}") > 0)
    return done.filter("_kind = 1").select(
        "_row.*", *[F.coalesce(f"_n_{i}", F.lit(0)).alias(f + suffix) for i, f in enumerate(fields)],
        *[F.coalesce(here(i) & F.col("_row")[f].isNotNull(), F.lit(False)).alias(f + new) for i, f in enumerate(fields)],
    )


def device_value(field: str) -> Column:
    """A device field; a missing one counts as the text ``null``."""
    return F.coalesce(F.col(f"deviceInfo.{field}"), F.lit("null"))


def page_statistics(
    pages: DataFrame, ties: Sequence[str] = (), hot_rows: int | None = None
) -> DataFrame:
    """Running page views and distinct devices and keywords per user, as comma lists; one row per page."""
    fields = ("os", "ch", "md", "ba")
    flat = pages.select(
        "uid", "ts", *[device_value(f).alias(f"_{f}") for f in fields],
        F.col("search_item").alias("_search_item"), *ties,
    )
    columns = {"pv": running_count()}
    for name in (*fields, "search_item"):
        columns[name] = running_set(F.col(f"_{name}"))
    done = with_running(flat, "uid", "ts", ties, columns, hot_rows)
    return done.select("uid", "pv", *[sorted_csv(F.col(f)).alias(f) for f in (*fields, "search_item")], "ts", *ties)


def order_statistics(
    orders: DataFrame, position: str, ties: Sequence[str] = (), hot_rows: int | None = None
) -> DataFrame:
    """Running distinct order fields per user, as comma lists; rows without ``op`` are left out."""
    fields = ("ts_ms", "total_amount", "create_time", "id")
    flat = orders.select(
        "user_id", "op", F.col(position).alias("_position"), *ties,
        *[F.coalesce(F.col(f).cast("string"), F.lit("null")).alias(f"_{f}") for f in fields],
        F.col("search_item").alias("_search_item"),
    )
    columns = {f: running_set(F.col(f"_{f}")) for f in (*fields, "search_item")}
    done = with_running(flat, "user_id", "_position", ties, columns, hot_rows).filter(F.col("op").isNotNull())
    return done.select("user_id", "op", *[sorted_csv(F.col(f)).alias(f) for f in columns])


def page_window_snapshots(
    pages: DataFrame, window_ms: int, hot_rows: int | None = None, hot_from: DataFrame | None = None
) -> DataFrame:
    """The last running page statistics of each user in each tumbling window.

    Equal to ``last_per_window(page_statistics(...))``, but pages are first counted per user, window,
    device and keyword, combined before the shuffle, so that only these counts run in order. ``hot_from``
    is a cheaper table with ``uid`` and ``ts`` to look for hot users in.
    """
    fields = ("os", "ch", "md", "ba", "search_item")
    start = (F.floor(F.col("ts") / window_ms) * window_ms).cast("bigint").alias("window_start")
    counted = (
        pages.select("uid", start, "ts", *[device_value(f).alias(f) for f in fields[:-1]], "search_item")
        .groupBy("uid", "window_start", *fields)
        .agg(F.count("*").alias("_views"), F.max("ts").alias("_ts"))
    )
    columns = {
        "_last": last_of_position("window_start"),
        "pv": running_sum(F.col("_views")),
        **{f"_{f}": running_set(F.col(f)) for f in fields},
        "ts": latest_time("_ts"),
    }
    users = (pages if hot_from is None else hot_from).select("uid", start)
    done = with_running(counted, "uid", "window_start", fields, columns, hot_rows, users, cut_ties=False).filter("_last")
    return done.select("uid", "window_start", "pv", *[sorted_csv(F.col(f"_{f}")).alias(f) for f in fields], "ts")


def last_per_window(
    df: DataFrame, key: str, time: str, window_ms: int, ties: Sequence[str] = ()
) -> DataFrame:
    """The last row of each key in each tumbling event-time window."""
    start = (F.floor(F.col(time) / window_ms) * window_ms).cast("bigint")
    latest_first = Window.partitionBy(key, "window_start").orderBy(*[F.desc(c) for c in (time, *ties)])
    return (
        df.withColumn("window_start", start)
        .withColumn("_place", F.row_number().over(latest_first))
        .filter("_place = 1")
        .drop("_place")
    )
