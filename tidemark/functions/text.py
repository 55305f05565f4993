"""Text, lists and keys."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V


def first_word(text: Column) -> Column:
    return F.split(text, " ")[0]


def first_item(csv: Column) -> Column:
    return F.split(csv, ",")[0]


def join_list(items: Column, delimiter: str = ", ") -> Column:
    """Items joined by ``delimiter``; a null item is written as ``null``, a null list stays null."""
    return F.array_join(items, delimiter, "null")


def sorted_csv(items: Column) -> Column:
    return F.array_join(F.array_sort(items), ",", "null")


def upper_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)))


def lower_first(text: Column) -> Column:
    return F.concat(F.lower(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)))


def zeros(n: Column) -> Column:
    return F.repeat(F.lit("0"), n)


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_blank(text: Column) -> Column:
    """Null, or nothing but characters up to the space."""
    return text.isNull() | text.rlike(r"^[\x00-\x20]*\z")


def is_present(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def is_allowed_text(text: Column) -> Column:
    return text.rlike(V.ALLOWED_TEXT)


def append_to_json_list(json_list: Column, item: Column) -> Column:
    items = F.coalesce(F.from_json(json_list, "array<string>"), F.array().cast("array<string>"))
    return F.to_json(F.array_append(items, item))


def hex_words(data: Column, width: int = 64) -> Column:
    """Payload after the two-character prefix, cut to whole words of ``width``, each with ``0x``."""
    count = F.floor((F.length(data) - 2) / width).cast("int")
    word = lambda i: F.concat(F.lit("0x"), F.substring(data, i * width + 3, F.lit(width)))
    words = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), word)
    return F.when(count > 0, words).otherwise(F.array().cast("array<string>"))


def hash_bucket(value: Column, buckets: int = V.HASH_BUCKETS) -> Column:
    """Four-digit bucket from the last three hex digits of the md5."""
    tail = F.conv(F.right(F.md5(value.cast("string")), F.lit(3)), 16, 10).cast("int")
    return F.lpad((tail % buckets).cast("string"), 4, "0")


def hot_key_bucket(value: Column, hot: dict[str, str] | None = None) -> Column:
    """Like :func:`hash_bucket`, but known hot keys get a bucket of their own."""
    hot = V.HOT_KEY_BUCKETS if hot is None else hot
    pairs = [F.lit(part) for pair in hot.items() for part in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(value)), hash_bucket(value))


@dataclass(frozen=True)
class KeyItem:
    field: str
    md5: bool = False


def row_key(items: Iterable[KeyItem], separator: str = "", md5: bool = False) -> Column:
    """Composite key: fields joined by ``separator``, each and the whole optionally hashed."""
    parts = [F.md5(F.col(i.field).cast("string")) if i.md5 else F.col(i.field).cast("string") for i in items]
    key = F.concat_ws(separator, *parts)
    return F.md5(key) if md5 else key


def camel_name(name: str) -> str:
    first, *rest = name.split("_")
    return first.lower() + "".join(part.capitalize() for part in rest)


def camel_case_columns(df: DataFrame) -> DataFrame:
    """Rename UNDER_SCORE columns to camelCase."""
    return df.toDF(*[camel_name(c) for c in df.columns])


def merge_maps(left: Column, right: Column) -> Column:
    """Both maps in one, the right value winning under equal keys."""
    only_left = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(only_left, right)


def to_json_row(df: DataFrame, column: str = "value") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(column))
