"""Removing repeated rows and keeping the latest ones.

Choosing one row per key is a ``row_number() = 1`` filter. Spark limits each key to one row before the
shuffle as well as after it, so a hot key or a large group of copies never travels whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import running, skew


def full_row(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_by(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row per key in the given order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def by_key_and_time(df: DataFrame, key: str, time: str = "ts_ms") -> DataFrame:
    """One row per key and time: the smallest by all other columns."""
    return first_by(df, [key, time], *[c for c in df.columns if c not in (key, time)])


def first_in_event_order(df: DataFrame, key: str, time: str = "ts_ms", ties: Sequence[str] = ()) -> DataFrame:
    """Rows newer than every earlier row of their key, when rows arrive in the order of ``time``.

    Then a row passes exactly when it is the first of its key and time, so no running maximum is needed.
    """
    return first_by(df, [key, time], *ties, *[c for c in df.columns if c not in (key, time, *ties)])


def increasing_only(
    df: DataFrame,
    key: str,
    time: str,
    arrival: str,
    ties: Sequence[str] = (),
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Rows whose ``time`` is above that of every earlier arrival of their key."""
    marked = running.with_running(
        df, key, arrival, ties, {"_earlier": running.earlier_max(F.col(time))}, hot_rows, hot_from
    )
    return marked.filter(F.col("_earlier").isNull() | (F.col(time) > F.col("_earlier"))).drop("_earlier")


def latest(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` columns per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return first_by(df, keys, *[F.desc(c) for c in order])


def earliest(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` columns per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return first_by(df, keys, *order)
