"""From parsed change rows and page logs to the columns each step needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, fixed_values as V
from tidemark.functions.numbers import long_or_zero
from tidemark.functions.text import first_word, is_present


def with_uid(df: DataFrame) -> DataFrame:
    """Rows with a non-empty uid."""
    return df.filter(is_present(F.col("uid")))


def with_id(df: DataFrame, column: str = "id") -> DataFrame:
    """Rows with a non-empty id."""
    return df.filter(is_present(F.col(column)))


def page(df: DataFrame, *extra: str) -> DataFrame:
    """uid, time, device block and searched keyword of a parsed page log."""
    common = F.col("common")
    device = common.dropFields("sid", "mid", "is_new").withField("os", first_word(F.col("common.os")))
    keyword = F.when(F.col("page.item_type") == "keyword", F.col("page.item"))
    return df.filter(common.isNotNull()).select(
        F.coalesce(F.col("common.uid"), F.lit(V.DEFAULT_UID)).alias("uid"),
        long_or_zero(F.col("ts")).alias("ts"),
        device.alias("deviceInfo"),
        keyword.alias("search_item"),
        *extra,
    )


def order(df: DataFrame) -> DataFrame:
    """Order row with its pay-time slot, from a change row with ``after`` parsed."""
    after = lambda name: F.col(f"after.{name}")
    created = long_or_zero(after("create_time"))
    return df.select(
        long_or_zero(F.col("ts_ms")).alias("ts_ms"),
        after("id").alias("id"),
        after("user_id").alias("uid"),
        after("consignee").alias("consignee"),
        created.alias("create_time"),
        after("original_total_amount").alias("original_total_amount"),
        after("total_amount").alias("total_amount"),
        long_or_zero(after("province_id")).alias("province_id"),
        dates.pay_time_slot(created).alias("pay_time_slot"),
    )


def order_detail(df: DataFrame) -> DataFrame:
    """Order line, from a change row with ``after`` parsed."""
    numbers = ("sku_num", "create_time", "sku_id")
    texts = (
        "split_coupon_amount", "sku_name", "order_price", "id", "order_id",
        "split_activity_amount", "split_total_amount",
    )
    return df.select(
        long_or_zero(F.col("ts_ms")).alias("ts_ms"),
        *[long_or_zero(F.col(f"after.{n}")).alias(n) for n in numbers],
        *[F.col(f"after.{n}").alias(n) for n in texts],
    )


def order_change(df: DataFrame) -> DataFrame:
    """Narrow order row that keeps its operation."""
    return df.select(
        "op",
        F.col("after.id").alias("order_id"),
        F.col("after.create_time").alias("create_time"),
        F.col("after.total_amount").alias("total_amount"),
        F.col("after.user_id").alias("uid"),
        "ts_ms",
    )


def order_detail_change(df: DataFrame) -> DataFrame:
    """Narrow order line that keeps its operation."""
    return df.select(
        "op",
        F.col("after.order_id").alias("order_id"),
        "ts_ms",
        F.col("after.sku_id").cast("string").alias("sku_id"),
    )


def user(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Demographic labels of a user row whose ``after.birthday`` is an epoch day.

    ``as_of`` is the date of the age, today by default.
    """
    day = dates.today() if as_of is None else F.lit(as_of).cast("date")
    born = dates.epoch_day_to_date(F.col("after.birthday"))
    copied = ("user_level", "login_name", "phone_num", "email")
    return df.select(
        F.col("after.id").alias("uid"),
        F.col("after.name").alias("uname"),
        *[F.col(f"after.{c}").alias(c) for c in copied],
        F.coalesce(F.col("after.gender"), F.lit(V.DEFAULT_GENDER)).alias("gender"),
        born.cast("string").alias("birthday"),
        long_or_zero(F.col("ts_ms")).alias("ts_ms"),
        dates.decade(born).alias("decade"),
        dates.age_on(born, day).alias("age"),
        dates.zodiac_sign(born).alias("zodiac_sign"),
    )


def user_supplement(df: DataFrame) -> DataFrame:
    """Height and weight of a user."""
    copied = ("uid", "height", "unit_height", "weight", "unit_weight", "create_ts")
    return df.select(*[F.col(f"after.{c}").alias(c) for c in copied], "ts_ms")


def restamp(df: DataFrame, time: str = "ts") -> DataFrame:
    """Take ``time`` as the row's ``ts_ms``."""
    return df.withColumn("ts_ms", F.col(time).cast("bigint"))


def right_wins(df: DataFrame, left: str, right: str) -> DataFrame:
    """Columns of two struct columns side by side, the right one's under equal names."""
    on_right = df.schema[right].dataType.names
    only_left = [n for n in df.schema[left].dataType.names if n not in on_right]
    return df.select(*[F.col(f"{left}.{n}") for n in only_left], f"{right}.*")


def plain_bucket_names(df: DataFrame) -> DataFrame:
    """Bucket columns of feeds that spell them ``18-24`` or ``18~24``, spelled ``18_24``."""
    plain = {}
    for name in df.columns:
        prefix, _, bucket = name.rpartition("_")
        if bucket.replace("-", "_").replace("~", "_") in V.BUCKETS:
            plain[name] = f"{prefix}_{bucket.replace('-', '_').replace('~', '_')}"
    return df.withColumnsRenamed(plain)
