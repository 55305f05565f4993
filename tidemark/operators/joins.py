"""Joins on key and time, and dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import running, skew

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    lower_ms: int,
    upper_ms: int,
    left_time: str = "ts_ms",
    right_time: str = "_right_ts",
) -> DataFrame:
    """Every pair with equal key and left + lower <= right <= left + upper (both inclusive).

    ``right`` brings its own time column name; all other right columns must differ from the left's.
    """
    gap = F.col(right_time) - F.col(left_time)
    return left.join(right, key).filter(gap.between(lower_ms, upper_ms))


def hot_interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    lower_ms: int,
    upper_ms: int,
    left_time: str = "ts_ms",
    right_time: str = "_right_ts",
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
    left_hot_from: DataFrame | None = None,
) -> DataFrame:
    """:func:`interval_join` for keys that may be hot on the right, or with ``left_hot_from`` on either side.

    Under a hot key the hot side is cut into time cells as wide as the interval, so a row of the other side
    meets only the two cells its interval touches instead of the key's whole history, and each cell is
    salted. Every row of the hot side is in one cell and one salt, so each pair comes out once. Other keys
    use one cell.

    ``hot_from`` and ``left_hot_from`` are cheaper tables to look for hot keys in.
    """
    bounds = (lower_ms, upper_ms, left_time, right_time)
    hot = skew.find_hot(right if hot_from is None else hot_from, key, hot_rows)
    left_hot = None if left_hot_from is None else skew.find_hot(left_hot_from, key, hot_rows)
    if left_hot is None:
        return _split_right(left, right, key, *bounds, hot)
    if hot is not None:
        left_hot = left_hot.join(F.broadcast(hot), key, "left_anti")
    keys = F.broadcast(left_hot.select(key))
    swapped = _split_right(
        right.join(keys, key, "left_semi"), left.join(keys, key, "left_semi"), key,
        -upper_ms, -lower_ms, right_time, left_time, left_hot,
    )
    rest = _split_right(left.join(keys, key, "left_anti"), right.join(keys, key, "left_anti"), key, *bounds, hot)
    return rest.unionByName(swapped)


def _split_right(
    left: DataFrame, right: DataFrame, key: str, lower_ms: int, upper_ms: int, left_time: str, right_time: str,
    hot: DataFrame | None,
) -> DataFrame:
    if hot is None:
        return interval_join(left, right, key, lower_ms, upper_ms, left_time, right_time)
    hot = F.broadcast(hot)
    is_hot = F.col("_parts").isNotNull()
    width = upper_ms - lower_ms + 1
    cell = lambda time: F.floor(time / width)
    none = F.lit(0).cast("bigint")

    cells = F.sequence(cell(F.col(left_time) + lower_ms), cell(F.col(left_time) + upper_ms))
    left_cells = (
        left.join(hot, key, "left")
        .withColumn("_cell", F.explode(F.when(is_hot, cells).otherwise(F.array(none))))
        .withColumn("_salt", skew.every_salt(F.col("_parts")))
        .drop("_parts")
    )
    right_cells = (
        right.withColumn("_any", skew.spread(right))
        .join(hot, key, "left")
        .withColumn("_salt", skew.salt(F.col("_parts"), F.col("_any")))
        .withColumn("_cell", F.when(is_hot, cell(F.col(right_time))).otherwise(none))
        .drop("_parts", "_any")
    )
    gap = F.col(right_time) - F.col(left_time)
    return (
        left_cells.join(right_cells, [key, "_cell", "_salt"])
        .filter(gap.between(lower_ms, upper_ms))
        .drop("_cell", "_salt")
    )


def latest_within(
    left: DataFrame,
    rights: dict[str, tuple[DataFrame, str, int, int]],
    key: str,
    left_time: str = "ts_ms",
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Per left row, the latest row of each right side in its interval, as one struct (without key) per side.

    ``rights`` maps a column name to (rows, time column, lower, upper). A side's latest row in the interval
    is the last one not after left + upper, provided it is not before left + lower. All sides go through
    one ordered pass per key, so no pairs are formed. Equal times are ordered by the right row's columns.
    A side without a row in the interval gives null.
    """
    sides = list(rights)

    def line(df: DataFrame, position, kind: int, payload: str):
        columns = {name: F.lit(None) for name in ("_left", *sides)}
        columns[payload] = F.struct(*[c for c in df.columns if c != key])
        return df.select(
            key, position.cast("bigint").alias("_at"), F.lit(kind).alias("_kind"),
            *[c.alias(n) for n, c in columns.items()],
        )

    rows = line(left, F.col(left_time), 1, "_left")
    for name, (df, time, _, upper) in rights.items():
        rows = rows.unionByName(line(df, F.col(time) - upper, 0, name))
    order = ["_kind", *sides]
    known = running.with_running(
        rows, key, "_at", order,
        {f"_last_{n}": running.last_known(F.col(n), ["_at", *order]) for n in sides},
        hot_rows,
        hot_from,
    ).filter(F.col("_left").isNotNull())
    picked = []
    for name, (_, time, lower, _) in rights.items():
        last = F.col(f"_last_{name}")
        fits = last[time] >= F.col("_left")[left_time] + lower
        picked.append(F.when(fits, last).alias(name))
    # The key itself, not a copy in the struct, so that a step by the same key needs no further shuffle.
    return known.select(*[F.col(c) if c == key else F.col("_left")[c].alias(c) for c in left.columns], *picked)


@dataclass(frozen=True)
class Within:
    """What to add up of the rows of one side: those with left + lower <= time <= left + upper, both inclusive."""

    rows: DataFrame
    lower_ms: int
    upper_ms: int
    count: str
    sums: dict[str, Column] = field(default_factory=dict)
    time: str = "ts_ms"


def totals_within(
    left: DataFrame,
    sides: list[Within],
    key: str,
    left_time: str = "ts_ms",
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Left rows, each with the number of rows and the sums of every side in its interval, without forming pairs.

    Along the ordered times of a key an interval's sum is the difference of two running sums: up to its end, and before
    its begin. All sides and both ends of all intervals go through one ordered pass, so the work is linear in the rows however
    many are in reach of each other. Values are added as decimals of six places, so a difference of long sums is
    exact; null values count as nothing. A left row without key, time or partner has counts and sums of 0. Equal left rows
    stay as many as they are.
    """
    exact = lambda c: F.coalesce(c.cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)"))
    names = [n for side in sides for n in (side.count, *side.sums)]
    places = {n: f"_sum_{i}" for i, n in enumerate(names)}
    whole = F.struct(*left.columns)
    nothing = F.lit(None).cast(left.select(whole.alias("w")).schema["w"].dataType)

    def line(df, at, kind: int, side: int, row, values: dict[str, Column]):
        zero = F.lit(0).cast("decimal(38,6)")
        return df.select(
            F.col(key).alias(key), at.cast("bigint").alias("_at"), F.lit(kind).alias("_kind"), F.lit(side).alias("_side"),
            row.alias("_row"), *[values.get(n, zero).alias(p) for n, p in places.items()],
        )

    rows = None
    for i, side in enumerate(sides):
        met = side.rows.filter(F.col(key).isNotNull() & F.col(side.time).isNotNull())
        values = {side.count: exact(F.lit(1)), **{n: exact(c) for n, c in side.sums.items()}}
        # At one time an interval's begin comes before the rows, and its end behind them.
        parts = [
            line(left, F.col(left_time) + side.lower_ms, 0, i, whole, {}),
            line(met, F.col(side.time), 1, i, nothing, values),
            line(left, F.col(left_time) + side.upper_ms, 2, i, whole, {}),
        ]
        for part in parts:
            rows = part if rows is None else rows.unionByName(part)
    done = running.with_running(
        rows.withColumnsRenamed({p: f"{p}_" for p in places.values()}), key, "_at", ["_kind"],
        {p: running.running_sum(F.col(f"{p}_")) for p in places.values()}, hot_rows, hot_from,
    ).filter(F.col("_row").isNotNull())
    ends = []
    for i, side in enumerate(sides):
        for n in (side.count, *side.sums):
            at = lambda kind: F.max(F.when((F.col("_side") == i) & (F.col("_kind") == kind), F.col(places[n])))
            ends.append((at(2) - at(0)).alias(places[n]))
    copies = F.count(F.when((F.col("_side") == 0) & (F.col("_kind") == 0), 1)).alias("_copies")
    found = done.groupBy(key, "_row").agg(copies, *ends)
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")))
    counts = {side.count for side in sides}
    return each.select(
        *[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in left.columns],
        *[F.col(p).cast("bigint" if n in counts else "double").alias(n) for n, p in places.items()],
    )


def small_enough(dim: DataFrame, max_rows: int | None = None, max_bytes: int = BROADCAST_BYTES) -> bool:
    """The check before a broadcast: rows and bytes of a dimension, by one map-side combined aggregate."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    width = F.lit(0)
    for column in dim.columns:
        width = width + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    rows, size = dim.agg(F.count("*"), F.sum(width.cast("bigint"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    columns: Sequence[str] | None = None,
    prefix: str = "",
    max_broadcast_rows: int | None = None,
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Add dimension columns by key; rows without a match pass with nulls. ``dim`` is unique by ``on``.

    A dimension that proves small is broadcast. A larger one is shuffled, with the rows of hot keys salted and
    rows without a key spread over all tasks. For a stream hot keys are only known from a static ``hot_from``.
    """
    columns = [c for c in dim.columns if c != on] if columns is None else list(columns)
    wanted = dim.select(on, *[F.col(c).alias(prefix + c) for c in columns])
    if small_enough(wanted, max_broadcast_rows):
        return df.join(F.broadcast(wanted), on, "left")
    counted = df if hot_from is None else hot_from
    hot = None if counted.isStreaming else skew.find_hot(counted, on, hot_rows)
    split, copied = skew.salted_pair(df, wanted, on, hot)
    return split.join(copied, [on, "_salt"], "left").drop("_salt")


def keep_left_join(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int | None = None, hot_from: DataFrame | None = None
) -> DataFrame:
    """Left outer join whose right side may have hot keys.

    AQE cannot split the right side of a left outer join, so under hot keys the matches come from a salted
    inner join and the unmatched left rows from an anti join.
    """
    hot = skew.find_hot(right if hot_from is None else hot_from, key, hot_rows)
    if hot is None:
        return left.join(right, key, "left")
    split, copied = skew.salted_pair(right, left, key, hot)
    matched = copied.join(split, [key, "_salt"]).drop("_salt")
    unmatched = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])
