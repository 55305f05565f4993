"""Dimensions as they were: lookups by the version that was valid at a row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cdc, running


def asof_lookup(
    df: DataFrame,
    changes: DataFrame,
    key: str,
    time: str,
    columns: Sequence[str],
    order: Sequence[str],
    prefix: str = "",
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Add dimension columns as the dimension's ``changes`` had left them at each row's ``time``.

    ``changes`` has ``key``, ``op``, the ``order`` columns (first the time, in the unit of ``time``; a change counts from its own
    time on) and the ``columns``. As in ``cdc.apply_changes`` a null column leaves the old value, and a delete is a gap until
    the next write. Rows of both tables go through one ordered pass per key, in which the last write of each column and the
    last delete are carried along, so a key's rows never meet all its versions. Rows without key or time, before the first
    change or in a gap get nulls.
    """
    whole = F.struct(*df.columns)
    nothing = F.lit(None).cast(df.select(whole.alias("w")).schema["w"].dataType)
    kinds = {c: changes.schema[c].dataType for c in (*columns, *order)}
    facts = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(time).cast("bigint").alias("_at"), F.lit(1).alias("_kind"), whole.alias("_row"),
        F.lit(None).cast("string").alias("_op"), *[F.lit(None).cast(kinds[c]).alias(f"_o_{c}") for c in order],
        *[F.lit(None).cast(kinds[c]).alias(f"_c_{c}") for c in columns],
    )
    versions = changes.filter(F.col(key).isNotNull() & F.col(order[0]).isNotNull()).select(
        F.col(key).alias("_key"), F.col(order[0]).cast("bigint").alias("_at"), F.lit(0).alias("_kind"), nothing.alias("_row"),
        F.col("op").alias("_op"), *[F.col(c).alias(f"_o_{c}") for c in order], *[F.col(c).alias(f"_c_{c}") for c in columns],
    )
    ties = ["_kind", *[f"_o_{c}" for c in order]]
    place = F.struct(*[f"_o_{c}" for c in order])
    write = (F.col("_kind") == 0) & (F.col("_op") != cdc.DELETE)
    last = {"_deleted": running.last_known(F.when(F.col("_op") == cdc.DELETE, place), ["_at", *ties])}
    for c in columns:
        last[f"_last_{c}"] = running.last_known(
            F.when(write & F.col(f"_c_{c}").isNotNull(), F.struct(place.alias("at"), F.col(f"_c_{c}").alias("value"))), ["_at", *ties]
        )
    users = None if hot_from is None else hot_from.select(F.col(key).alias("_key"), F.col(time).cast("bigint").alias("_at"))
    done = running.with_running(facts.unionByName(versions), "_key", "_at", ties, last, hot_rows, users).filter("_kind = 1")

    def held(c: str):
        found = F.col(f"_last_{c}")
        return F.when(F.col("_deleted").isNull() | (found["at"] > F.col("_deleted")), found["value"]).alias(prefix + c)

    rest = df.filter(F.col(key).isNull() | F.col(time).isNull())
    return done.select("_row.*", *map(held, columns)).unionByName(
        rest.select("*", *[F.lit(None).cast(kinds[c]).alias(prefix + c) for c in columns])
    )


def intervals(changes: DataFrame, key: str, columns: Sequence[str], order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """The versions of a dimension: key, columns, ``valid_from`` and ``valid_to`` (the next change, or null).

    Of changes at one time the state after the last one is the version. Deletes end a version and begin none.
    """
    at = order[0]
    times = changes.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).groupBy(key, at).agg(F.max("op").alias("_any"))
    states = asof_lookup(
        times.select(key, F.col(at).alias("valid_from")), changes.withColumn("_alive", F.lit(True)), key, "valid_from",
        [*columns, "_alive"], order, hot_rows=hot_rows,
    )
    # In falling order of time the version before a row is the next one.
    falling = states.withColumn("_back", -F.col("valid_from").cast("bigint"))
    nearest = {"valid_to": running.earlier_max(F.col("_back"))}
    ended = running.with_running(falling, key, "_back", [], nearest, hot_rows)
    return ended.filter("_alive").select(key, *columns, "valid_from", (-F.col("valid_to")).alias("valid_to"))
