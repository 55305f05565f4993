"""Numbers read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEI_PER_ETHER_DIGITS = 18


def round3(value: Column) -> Column:
    """Three places, half up."""
    return F.round(value, 3)


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def long_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Hex digits read at a time, and decimal digits to a limb: a limb times 16**7 plus a carry stays far below 2**63.
HEX_STEP, LIMB_DIGITS = 7, 9
HEX_BASE, LIMB_BASE = 16**HEX_STEP, 10**LIMB_DIGITS


def hex_digits_to_decimal(digits: Column) -> Column:
    """The decimal digits of a hex number of any length, without leading zeros, by long multiplication.

    The number is a list of limbs of nine decimal digits, lowest first. For every seven hex digits all limbs are multiplied
    and the carry is passed up.
    """
    big = lambda x: F.lit(x).cast("bigint")
    limbs = lambda: F.array().cast("array<bigint>")

    def carry(state: Column, limb: Column) -> Column:
        return let(limb * big(HEX_BASE) + state["carry"], lambda t: F.struct(
            F.array_append(state["out"], t % big(LIMB_BASE)).alias("out"), F.call_function("div", t, big(LIMB_BASE)).alias("carry")))

    def times_plus(number: Column, step: Column) -> Column:
        start = F.struct(limbs().alias("out"), step.alias("carry"))
        last = lambda s: F.when(s["carry"] > 0, F.array_append(s["out"], s["carry"])).otherwise(s["out"])
        return F.aggregate(number, start, carry, last)

    def whole(padded: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded), F.lit(HEX_STEP))
        steps = F.transform(starts, lambda i: F.conv(F.substring(padded, i, F.lit(HEX_STEP)), 16, 10).cast("bigint"))
        number = F.aggregate(steps, limbs(), times_plus)
        parts = F.transform(F.reverse(number), lambda limb: F.lpad(limb.cast("string"), LIMB_DIGITS, "0"))
        return F.array_join(parts, "")

    length = (F.ceil(F.greatest(F.length(digits), F.lit(1)) / HEX_STEP) * HEX_STEP).cast("int")
    return without_zeros(let(F.lpad(digits, length, F.lit("0")), whole))


def without_zeros(digits: Column) -> Column:
    """Digits without leading zeros, ``0`` at least."""
    return let(F.ltrim(digits, F.lit("0")), lambda d: F.when(d == "", "0").otherwise(d))


NUMBER = r"^([+-]?)(?=\.?[0-9])([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]+))?$"


def hex_or_decimal_to_text(value: Column, in_ether: bool = False) -> Column:
    """Hex (``0x``) or decimal text of any length as plain decimal text, divided by 10**18 if ``in_ether``; null is ``0``.

    The places after the point stay as written; those that come in by the division end at the last digit that is not 0.
    Other text stops with an error. All in expressions, as 256 bits fit no number type of Spark.
    """
    shift = WEI_PER_ETHER_DIGITS if in_ether else 0
    is_hex = value.startswith("0x")
    bad_hex = is_hex & ~value.rlike("^0x[0-9a-fA-F]*$")
    bad = F.coalesce(bad_hex | (~is_hex & ~value.rlike(NUMBER)), F.lit(False))
    part = lambda i: F.regexp_extract(value, NUMBER, i)
    written = F.struct(
        F.when(is_hex, "").otherwise(F.when(part(1) == "-", "-").otherwise("")).alias("sign"),
        F.when(is_hex, hex_digits_to_decimal(F.substring(value, F.lit(3), F.length(value)))).otherwise(F.concat(part(2), part(3))).alias("digits"),
        F.when(is_hex, 0).otherwise(F.length(part(3)) - F.coalesce(part(4).try_cast("int"), F.lit(0))).alias("scale"),
    )
    text = let(written, lambda n: placed(n["sign"], without_zeros(n["digits"]), n["scale"], shift))
    return F.when(bad, F.raise_error(F.concat(F.lit("no number: "), value)).cast("string")).otherwise(
        F.when(value.isNull(), "0").otherwise(text)
    )


def placed(sign: Column, digits: Column, scale: Column, shift: int) -> Column:
    """Digits with the point ``scale`` + ``shift`` places from the right."""

    def pointed(n: Column) -> Column:
        digits, scale = n["digits"], n["scale"]
        padded = F.lpad(digits, F.greatest(F.length(digits), scale + 1), F.lit("0"))
        whole = F.concat(digits, F.repeat(F.lit("0"), F.greatest(-scale, F.lit(0))))
        with_point = let(padded, lambda p: F.concat(
            F.substring(p, F.lit(1), F.length(p) - scale), F.lit("."), F.substring(p, F.length(p) - scale + 1, scale)))
        return F.when(scale > 0, with_point).otherwise(F.when(digits == "0", "0").otherwise(whole))

    # Zeros at the end go, as far as the division has brought in places. All digits of 0 are such.
    own = F.greatest(scale, F.lit(0))
    zeros = F.when(digits == "0", scale + shift).otherwise(F.length(digits) - F.length(F.rtrim(digits, F.lit("0"))))
    cut = F.least(zeros, F.greatest(scale + shift - own, F.lit(0))) if shift else F.lit(0)
    shorter = let(cut, lambda c: F.struct(
        F.when(digits == "0", "0").otherwise(F.substring(digits, F.lit(1), F.length(digits) - c)).alias("digits"),
        (scale + shift - c).alias("scale")))
    return F.concat(sign, let(shorter, pointed))
