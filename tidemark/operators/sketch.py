"""A sketch of known keys in front of an exact test, so that only rows that may be known are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per known key and hash, and the most bits of a sketch (16 MB): it is sent to all tasks.
BITS_PER_KEY = 8
MOST_BITS = 1 << 27
LEAST_BITS = 1 << 15


def positions(columns: Sequence[str], bits: int) -> list[Column]:
    """Two bits of a row's key in one sketch, as in a Bloom filter with two hashes."""
    first = F.xxhash64(*columns)
    return [F.pmod(h, F.lit(bits)) for h in (first, F.xxhash64(first, *columns))]


def sketch(known: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """Bitmaps of the keys' bits by bitmap number, made by map-side combined aggregates; ``bits`` / 8 bytes at most."""
    each = known.select(F.explode(F.array(*positions(columns, bits))).alias("at"))
    return each.groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits"))


def sized(known: DataFrame) -> int:
    """Bits for this many keys, a power of two within the bounds."""
    wanted = known.count() * 2 * BITS_PER_KEY
    bits = LEAST_BITS
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    return bits


def may_be_known(df: DataFrame, known: DataFrame, columns: Sequence[str], bits: int, into: str = "_maybe") -> DataFrame:
    """``df`` with whether a row's key may be among the known ones; False is sure. Nulls count as equal."""
    found = sketch(known, columns, bits)
    out = df
    for i, at in enumerate(positions(columns, bits)):
        part = F.broadcast(found.select(F.col("_bucket").alias(f"_bucket_{i}"), F.col("_bits").alias(f"_bits_{i}")))
        out = out.withColumn(f"_bucket_{i}", F.bitmap_bucket_number(at)).withColumn(f"_bit_{i}", F.bitmap_bit_position(at))
        out = out.join(part, f"_bucket_{i}", "left")

    def is_set(i: int) -> Column:
        bit = F.col(f"_bit_{i}")
        byte = F.conv(F.hex(F.substring(f"_bits_{i}", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
        return F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))

    return out.select(*df.columns, (is_set(0) & is_set(1)).alias(into))


def unknown(df: DataFrame, known: DataFrame, columns: Sequence[str], bits: int | None = None) -> DataFrame:
    """Rows whose key is not among the known ones, repeats included; nulls count as equal.

    What the sketch is sure about stays where it is. The rest goes through an exact anti join, so the result doesn't depend
    on the sketch, which only grows full beyond ``MOST_BITS`` / 16 keys.
    """
    keys = known.select(*columns).distinct()
    flagged = may_be_known(df, keys, columns, bits or sized(keys))
    named = keys.select(*[F.col(c).alias(f"_k_{c}") for c in columns])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns]
    sure = flagged.filter(~F.col("_maybe")).drop("_maybe")
    return sure.unionByName(flagged.filter("_maybe").drop("_maybe").join(named, same, "left_anti"))
