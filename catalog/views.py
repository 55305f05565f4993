"""The given tables reshaped into the feeds the library reads.

Times are epoch milliseconds counted from 2024-01-01 UTC, where the events table starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import DAY_MS, HOUR_MS, wall_clock_millis

START_MS = 1_704_067_200_000

# Brand by sku, category by part type, spelled as the scoring rules spell them.
BRANDS = ("TCL", "苹果", "联想", "欧莱雅", "香奈儿", "其他")
CATEGORY_OF_TYPE = {
    "ECONOMY": "手机", "LARGE": "家居家装", "MEDIUM": "数码", "PROMO": "母婴", "SMALL": "厨具", "STANDARD": "其他",
}
# Keyword categories and the search category each is compared to.
FIRST_CATEGORIES = ("手机", "母婴", "厨具", "图书", "珠宝", "服饰内衣", "食品")
SEARCH_CATEGORIES = ("时尚与潮流", "性价比", "健康与养生", "家庭与育儿", "科技与数码", "学习与发展", "其他")
OPS = ("d", "u", "u", "r", "r", "c", "c", "c", "c", "c")
ORDER_NAMES = ("苹果", "欧莱雅", "Redmi", "长粒香", "其他")


def pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def nested(df: DataFrame, plain: list[Column], wanted: tuple[str, ...] = (), **structs: list[Column]) -> DataFrame:
    """Plain columns, and struct columns of aliased fields: of all fields, or of the wanted ones."""

    def struct(fields: list[Column]) -> Column:
        names = df.select(*fields).columns
        return F.struct(*[f for f, n in zip(fields, names) if not wanted or n in wanted])

    return df.select(*plain, *[struct(fields).alias(name) for name, fields in structs.items()])


class Views:
    """Views over one data folder; each reads only the columns it names."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Change rows with ``after`` parsed. The wanted fields of ``after`` can be named, so that a query on few
    # fields reads few columns.

    def order_changes(self, *wanted: str) -> DataFrame:
        key = F.col("o_orderkey")
        amount = (F.col("o_totalprice") / 100).cast("string")
        return nested(
            self.table("orders"),
            [pick(OPS, key % 10).alias("op"), order_time(key).alias("ts_ms")],
            wanted,
            after=[
                key.cast("string").alias("id"),
                F.col("o_custkey").cast("string").alias("user_id"),
                F.col("o_orderpriority").alias("consignee"),
                order_time(key).alias("create_time"),
                amount.alias("original_total_amount"),
                amount.alias("total_amount"),
                (F.col("o_custkey") % 34).alias("province_id"),
            ],
        )

    def detail_changes(self, *wanted: str) -> DataFrame:
        key = F.col("l_orderkey")
        time = detail_time(key, F.col("l_linenumber"))
        return nested(
            self.table("lineitem"),
            [pick(OPS, key % 10).alias("op"), time.alias("ts_ms")],
            wanted,
            after=[
                (key * 10 + F.col("l_linenumber")).cast("string").alias("id"),
                key.cast("string").alias("order_id"),
                F.col("l_partkey").alias("sku_id"),
                F.concat(F.lit("sku "), F.col("l_partkey")).alias("sku_name"),
                F.col("l_quantity").cast("bigint").alias("sku_num"),
                F.col("l_extendedprice").cast("string").alias("order_price"),
                time.alias("create_time"),
                F.col("l_discount").cast("string").alias("split_coupon_amount"),
                F.col("l_tax").cast("string").alias("split_activity_amount"),
                F.col("l_extendedprice").cast("string").alias("split_total_amount"),
            ],
        )

    def user_changes(self) -> DataFrame:
        key = F.col("c_custkey")
        return nested(
            self.table("customer"),
            [F.lit("r").alias("op"), user_time(key).alias("ts_ms")],
            after=[
                key.cast("string").alias("id"),
                F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("user_level"),
                F.lower("c_name").alias("login_name"),
                F.concat(F.lit("phone-"), key).alias("phone_num"),
                F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
                pick(("M", "F", None), key % 3).alias("gender"),
                (key * 97 % 20000 - 7305).cast("int").alias("birthday"),
            ],
        )

    def supplement_changes(self) -> DataFrame:
        key = F.col("c_custkey")
        offset = (key % 13 - 6) * DAY_MS + F.when(key % 13 == 11, key % 2).otherwise(0)
        time = user_time(key) + offset
        return nested(
            self.table("customer"),
            [F.lit("r").alias("op"), time.alias("ts_ms")],
            after=[
                key.cast("string").alias("uid"),
                (key % 50 + 150).cast("string").alias("height"),
                F.lit("cm").alias("unit_height"),
                (F.floor(F.abs("c_acctbal")) % 60 + 45).cast("string").alias("weight"),
                F.lit("kg").alias("unit_weight"),
                time.alias("create_ts"),
            ],
        )

    def page_logs(self) -> DataFrame:
        """Parsed page logs; event_id is kept to order pages of one user and millisecond."""
        k = F.get_json_object("props", "$.k").cast("int")
        is_view = F.col("event_type") == "view"
        return nested(
            self.table("events"),
            [wall_clock_millis(F.col("ts")).alias("ts"), F.col("event_id")],
            common=[
                F.concat(F.lit("area-"), F.col("user_id") % 34).alias("ar"),
                pick(("xiaomi", "vivo", "Redmi", None), F.col("event_id") % 4).alias("ba"),
                F.col("event_type").alias("ch"),
                (F.col("event_id") % 2).cast("string").alias("is_new"),
                F.concat(F.lit("model-"), F.col("event_id") % 5).alias("md"),
                F.concat(F.lit("mid-"), F.col("user_id")).alias("mid"),
                pick(("Android 12", "iOS 13.3.1", "Windows 10"), F.col("event_id") % 3).alias("os"),
                F.col("event_id").cast("string").alias("sid"),
                F.col("user_id").cast("string").alias("uid"),
                F.lit("v2.1").alias("vc"),
            ],
            page=[
                F.lit(1000).cast("bigint").alias("during_time"),
                F.when(is_view, pick((*CATEGORY_OF_TYPE, "NONE"), k % 7)).otherwise(F.lit("item")).alias("item"),
                F.when(is_view, "keyword").otherwise("sku_id").alias("item_type"),
                F.lit("home").alias("last_page_id"),
                F.lit("list").alias("page_id"),
            ],
        )

    # Raw text feeds.

    def change_feed(self) -> DataFrame:
        """Orders and details as envelope text; some lines are cut short and do not parse."""

        def envelope(df: DataFrame, name: str) -> DataFrame:
            after = F.to_json("after")
            deleted = F.col("op") == "d"
            return df.select(
                F.to_json(
                    F.struct(
                        F.when(deleted, after).alias("before"),
                        F.when(~deleted, after).alias("after"),
                        F.struct(F.lit("shop").alias("db"), F.lit(name).alias("table"), "ts_ms").alias("source"),
                        "op",
                        "ts_ms",
                    )
                ).alias("value"),
                F.col("after.id").cast("bigint").alias("_key"),
            )

        both = envelope(self.order_changes(), "order_info").unionByName(
            envelope(self.detail_changes(), "order_detail")
        )
        cut = F.when(F.col("_key") % 97 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
        return both.select(written_once(cut))

    def page_feed_text(self) -> DataFrame:
        return self.page_logs().select(written_once(F.to_json(F.struct("common", "page", "ts"))))

    # Dimensions.

    def sku_dim(self) -> DataFrame:
        """sku, product, third-level category and brand; every sku twice, so that the first one counts."""
        part = self.table("part")
        rows = part.select(
            F.col("p_partkey").alias("skuid"),
            F.explode(F.array(F.lit(0), F.lit(1))).alias("spuid"),
            F.col("p_type").alias("c3id"),
            pick(BRANDS, F.col("p_partkey") % 6).alias("tname"),
        )
        return rows.withColumn("tname", F.when(F.col("spuid") == 0, F.col("tname")).otherwise("late"))

    def type_categories(self) -> DataFrame:
        """Category rows by part type, one per part."""
        names = F.create_map(*[F.lit(x) for pair in CATEGORY_OF_TYPE.items() for x in pair])
        return self.table("part").select(
            F.col("p_type").alias("id"), F.element_at(names, F.col("p_type")).alias("b1name")
        )

    def name_categories(self) -> DataFrame:
        """Category rows by number whose third-level names repeat."""
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_type").alias("b3name"),
            F.col("p_brand").alias("b2name"),
            pick(FIRST_CATEGORIES, F.col("p_partkey") % 7).alias("b1name"),
        )

    def comparison(self) -> DataFrame:
        """Category comparison rows; names repeat."""
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.cast("int").alias("id"),
            pick(FIRST_CATEGORIES, key % 7).alias("category_name"),
            pick(SEARCH_CATEGORIES, (key % 7 + F.floor(key / 7)) % 7).alias("search_category"),
        )

    def category_levels(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        c3 = self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("category2_id")
        )
        c2 = self.table("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("category1_id")
        )
        c1 = self.table("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
        return c3, c2, c1

    def sku_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        sku = self.table("part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 120).alias("spu_id"))
        spu = self.table("supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("category3_id"),
            (F.col("s_suppkey") % 25).alias("tm_id"),
        )
        trademark = self.table("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("tm_name"))
        return sku, spu, trademark

    def dictionary(self) -> DataFrame:
        """Category and brand names by third-level category, for orders."""
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.alias("base_category_id"),
            pick(SEARCH_CATEGORIES, key % 7).alias("base_category_name"),
            pick(ORDER_NAMES, key % 5).alias("base_trademark_name"),
        )

    def dictionary_skus(self) -> DataFrame:
        """sku with a third-level category that the dictionary has for most."""
        return self.table("part").select(
            F.col("p_partkey").alias("id"), (F.col("p_size") % 28).cast("int").alias("category3_id")
        )

    def overrides(self) -> DataFrame:
        """Order names that replace the looked-up ones, for orders of one status."""
        return self.table("orders").filter(F.col("o_orderstatus") == "P").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            pick(SEARCH_CATEGORIES, F.col("o_custkey") % 7).alias("base_category_name"),
            pick(ORDER_NAMES, F.col("o_custkey") % 5).alias("base_trademark_name"),
        )

    # Where to look for hot users without computing a feed.

    def page_users(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").cast("string").alias("uid"), wall_clock_millis(F.col("ts")).alias("_at")
        )

    def order_users(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").cast("string").alias("uid"), order_time(F.col("o_orderkey")).alias("_at")
        )

    def busy_users(self) -> DataFrame:
        return self.page_users().unionByName(self.order_users())


def written_once(text: Column) -> Column:
    """Text as ``value``, made once per row however often the reader's filters mention it."""
    return F.explode(F.array(text)).alias("value")


def order_time(key: Column) -> Column:
    return (F.lit(START_MS) + key % 30 * DAY_MS + key % 24 * HOUR_MS).cast("bigint")


def detail_time(key: Column, line: Column) -> Column:
    return (F.lit(START_MS) + key % 30 * DAY_MS + (key % 24 + line - 3) * HOUR_MS).cast("bigint")


def user_time(key: Column) -> Column:
    return (F.lit(START_MS) + key % 28 * DAY_MS).cast("bigint")
