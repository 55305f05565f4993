"""Finding and splitting hot keys.

One key may hold a large share of all rows. ``find_hot`` asks the data for the keys above a row count, and for how
many parts each should be cut into. When there are none, the operators built on it use their plain plan.

The list only steers how rows are spread over tasks and never which rows come out. So it is safe to find it in a
sample of one column, to take it from any cheaper table with the same keys, such as the raw log behind a feed, and to
broadcast it: it has at most one key per ``min_rows`` rows. It is found once per join, before the join is planned, so
both sides use one list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000
SAMPLED_ROWS = 2_000
#: Parts of a hot key per ``min_rows`` rows.
PARTS = 4
#: Quantiles at which the positions of a hot key are cut first, before even cuts between them.
QUANTILES = 16
#: Parts into which the rows of one heavy position are cut by their tie.
TIE_CUTS = 64


def hot_keys(df: DataFrame, key: str, min_rows: int | None = None, position: str | None = None) -> DataFrame:
    """The hot keys of ``df``, hottest first, with their rows and ``_parts``; with ``position``, also its quantiles.

    Rows are counted in a sample in which a key of ``min_rows`` has about ``SAMPLED_ROWS``.
    """
    min_rows = min_rows or HOT_ROWS
    fraction = min(1.0, SAMPLED_ROWS / min_rows)
    columns, extra = [key], []
    if position is not None:
        at = [i / QUANTILES for i in range(QUANTILES + 1)]
        columns.append(position)
        extra.append(F.percentile_approx(position, at, 10_000).alias("_cuts"))
    rows = df.select(*columns).filter(F.col(key).isNotNull())
    if fraction < 1:
        rows = rows.sample(fraction, seed=1)
    return (
        rows.groupBy(key)
        .agg((F.count("*") / F.lit(fraction)).alias("_rows"), *extra)
        .filter(F.col("_rows") >= min_rows)
        .withColumn("_parts", F.greatest(F.ceil(F.col("_rows") * PARTS / min_rows), F.lit(2)).cast("int"))
        .orderBy(F.desc("_rows"), F.col(key))
    )


def _found(hot: DataFrame) -> DataFrame | None:
    rows = hot.collect()
    return hot.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def find_hot(df: DataFrame, key: str, min_rows: int | None = None) -> DataFrame | None:
    """Hot keys with their ``_parts``, or None."""
    return _found(hot_keys(df, key, min_rows).select(key, "_parts"))


def find_hot_ranges(df: DataFrame, key: str, position: str, min_rows: int | None = None) -> DataFrame | None:
    """Hot keys with the ``_cuts`` of their ``position`` and the even parts (``_even``) between two cuts, or None."""
    even = F.ceil(F.col("_parts") / QUANTILES).cast("int").alias("_even")
    return _found(hot_keys(df, key, min_rows, position).select(key, "_cuts", even))


def tie_number(df: DataFrame, tie: str) -> Column | None:
    """A number that grows with a tie column, so that rows of one position can be cut by it: whole numbers as they are, of
    texts the first seven bytes. Nulls are lowest. Other types have none."""
    kind = df.schema[tie].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        return F.coalesce(F.col(tie).cast("bigint"), F.lit(-(1 << 63)))
    if kind == "string":
        start = F.substring(F.col(tie).cast("binary"), 1, 7)
        return F.coalesce(F.conv(F.rpad(F.hex(start), 14, "0"), 16, 10).cast("bigint"), F.lit(-1))
    return None


def find_heavy(
    df: DataFrame, ranges: DataFrame, key: str, position: str, tie: str, min_rows: int | None = None, hot_from: DataFrame | None = None
) -> DataFrame | None:
    """Per hot key the positions with more than ``min_rows`` rows each, with ``TIE_CUTS`` quantiles of ``tie`` there, or None.

    Positions are counted in a sample; only where there are any is the tie looked at.
    """
    number = tie_number(df, tie)
    if number is None:
        return None
    min_rows = min_rows or HOT_ROWS
    fraction = min(1.0, SAMPLED_ROWS / min_rows)
    source = (df if hot_from is None else hot_from).select(key, position).filter(F.col(position).isNotNull())
    rows = source.sample(fraction, seed=1) if fraction < 1 else source
    counts = rows.join(F.broadcast(ranges.select(key)), key, "left_semi").groupBy(key, position).agg((F.count("*") / F.lit(fraction)).alias("_rows"))
    heavy = _found(counts.filter(F.col("_rows") > min_rows).select(key, position))
    if heavy is None:
        return None
    rows = df.select(key, position, number.alias("_tie")).join(F.broadcast(heavy), [key, position], "left_semi")
    rows = rows.sample(fraction, seed=1) if fraction < 1 else rows
    at = [i / TIE_CUTS for i in range(1, TIE_CUTS)]
    cuts = rows.groupBy(key, position).agg(F.array_distinct(F.percentile_approx("_tie", at, 10_000)).alias("cuts"))
    each = F.struct(F.col(position).alias("at"), "cuts")
    return _found(cuts.groupBy(key).agg(F.array_sort(F.collect_list(each)).alias("_heavy")))


def with_tie_chunk(df: DataFrame, heavy: DataFrame, key: str, position: str, tie: str) -> DataFrame:
    """``_chunk`` made finer: each heavy position has chunks of its own, cut by the tie, between those of what is before and
    behind it."""
    at, number = F.col(position), tie_number(df, tie)
    joined = df.join(F.broadcast(heavy), key, "left")
    before = F.size(F.filter("_heavy", lambda h: h["at"] < at))
    mine = F.get(F.filter("_heavy", lambda h: h["at"] == at), F.lit(0))
    inside = F.size(F.filter(mine["cuts"], lambda c: c <= number))
    finer = F.col("_chunk") * (1 << 32) + (2 * before + F.when(mine.isNotNull(), 1).otherwise(0)).cast("bigint") * (1 << 16) + F.when(mine.isNotNull(), inside).otherwise(0)
    return joined.withColumn("_chunk", F.when(F.col("_heavy").isNotNull() & at.isNotNull(), finer).otherwise(F.col("_chunk") * (1 << 32))).drop("_heavy")


def with_chunk(df: DataFrame, ranges: DataFrame, key: str, position: str) -> DataFrame:
    """Number the chunk of ``position`` each row of a hot key is in; rows of other keys get chunk 0.

    Chunks grow with the position, and rows without one come first, as in a sort. The cuts follow the rows, so a few
    far positions or a burst do not put the others in one chunk; rows of one position stay together, see :func:`with_tie_chunk`.
    """
    at = F.col(position)
    cut = F.least(F.greatest(F.size(F.filter("_cuts", lambda x: x <= at)), F.lit(1)), F.lit(QUANTILES))
    low, high = F.get("_cuts", cut - 1), F.get("_cuts", cut)
    part = F.floor((at - low) / (F.floor((high - low) / F.col("_even")) + 1))
    inside = F.least(F.greatest(part, F.lit(0)), F.col("_even") - 1)
    chunk = F.when(at.isNull(), -1).otherwise((cut - 1) * F.col("_even") + inside)
    hot = F.col("_even").isNotNull()
    joined = df.join(F.broadcast(ranges), key, "left")
    return joined.withColumn("_chunk", F.when(hot, chunk).otherwise(0).cast("bigint")).drop("_cuts", "_even")


def spread(df: DataFrame) -> Column:
    """A number from the row's own values, so that a re-run task puts a row where it was."""
    return F.xxhash64(*df.columns).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def salt(hot_parts: Column, number: Column) -> Column:
    """The part of a hot key a row is in; zero for other keys."""
    return F.when(hot_parts.isNotNull(), F.pmod(number, hot_parts)).otherwise(0)


def every_salt(hot_parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(hot_parts, F.lit(1)) - 1))


def salted_pair(big: DataFrame, other: DataFrame, key: str, hot: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Give both sides a ``_salt`` to join on: hot keys of ``big`` are split, ``other`` copied to match.

    Rows of ``other`` under any other key are not copied. Rows of ``big`` without a key match nothing and
    are spread by their own hash.
    """
    if hot is None:
        split = big.withColumn("_salt", F.when(F.col(key).isNull(), spread(big)).otherwise(0))
        return split, other.withColumn("_salt", F.lit(0))
    hot = F.broadcast(hot)
    number = F.when(F.col(key).isNull(), F.col("_any")).otherwise(salt(F.col("_parts"), F.col("_any")))
    split = big.withColumn("_any", spread(big)).join(hot, key, "left").withColumn("_salt", number).drop("_parts", "_any")
    copied = other.join(hot, key, "left").withColumn("_salt", every_salt(F.col("_parts"))).drop("_parts")
    return split, copied
