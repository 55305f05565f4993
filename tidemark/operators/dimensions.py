"""Dimension tables and the lookups that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import dedup, joins


def category_hierarchy(category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """id and the names of all three levels; incomplete chains are left out."""
    c2 = category2.select(F.col("id").alias("category2_id"), F.col("name").alias("b2name"), "category1_id")
    c1 = category1.select(F.col("id").alias("category1_id"), F.col("name").alias("b1name"))
    return (
        category3.select("id", F.col("name").alias("b3name"), "category2_id")
        .join(c2, "category2_id")
        .join(c1, "category1_id")
        .select("id", "b3name", "b2name", "b1name")
    )


def sku_dimension(sku: DataFrame, spu: DataFrame, trademark: DataFrame) -> DataFrame:
    """sku with its product, third-level category and brand name."""
    p = spu.select(F.col("id").alias("spuid"), F.col("category3_id").alias("c3id"), "tm_id")
    t = trademark.select(F.col("id").alias("tm_id"), F.col("tm_name").alias("tname"))
    return (
        sku.select(F.col("id").alias("skuid"), F.col("spu_id").alias("spuid"))
        .join(p, "spuid")
        .join(t, "tm_id")
        .select("skuid", "spuid", "c3id", "tname")
    )


def sku_names(sku: DataFrame, dictionary: DataFrame) -> DataFrame:
    """sku with its category and brand names, null where the dictionary has none."""
    names = dictionary.select(
        F.col("base_category_id").alias("category3_id"),
        F.col("base_category_name").alias("bcname"),
        F.col("base_trademark_name").alias("btname"),
    )
    skus = sku.select(F.col("id").alias("sku_id"), "category3_id")
    return joins.lookup_join(skus, names, "category3_id").select("sku_id", "bcname", "btname")


def order_categories(
    orders: DataFrame, details: DataFrame, sku: DataFrame, dictionary: DataFrame
) -> DataFrame:
    """Every order line with the category and brand names of its sku, null where unknown.

    The dictionary is joined to the sku table first, so the lines are enriched in one lookup and shuffled
    once, for the order join.
    """
    bought = details.select("order_id", "sku_id", F.col("order_price").alias("price"))
    lines = joins.lookup_join(bought, sku_names(sku, dictionary), "sku_id")
    heads = orders.select(F.col("id").alias("order_id"), "uid", "create_time")
    return joins.keep_left_join(heads, lines, "order_id", hot_from=details.select("order_id")).select(
        "order_id", "uid", "bcname", "btname", "price", "create_time"
    )


def enrich_by_sku(
    lines: DataFrame, sku_dim: DataFrame, categories: DataFrame, hot_from: DataFrame | None = None
) -> DataFrame:
    """Add c3id and tname by sku, then b1_name by third-level category; the first match of each counts.

    ``hot_from`` is a cheaper table with ``sku_id`` to look for hot skus in, should the sku table be large.
    """
    first_sku = dedup.earliest(sku_dim.select("skuid", "spuid", "c3id", "tname"), "skuid", ["spuid", "c3id", "tname"])
    sku = F.col("sku_id").cast("string").alias("_sku")
    by_sku = joins.lookup_join(
        lines.select("*", sku),
        first_sku.select(
            F.col("skuid").cast("string").alias("_sku"), F.col("c3id").cast("string").alias("c3id"), "tname"
        ),
        "_sku",
        hot_from=(lines if hot_from is None else hot_from).select(sku),
    ).drop("_sku")
    first_category = dedup.earliest(
        categories.select(F.col("id").cast("string").alias("c3id"), F.col("b1name").alias("b1_name")),
        "c3id", ["b1_name"],
    )
    return joins.lookup_join(by_sku, first_category, "c3id")


def keyword_categories(categories: DataFrame, comparison: DataFrame) -> DataFrame:
    """Keyword (a third-level category name) to first-level category and search category.

    The category with the largest id wins a repeated name; the smallest id wins in the comparison table.
    """
    by_name = categories.groupBy(F.col("b3name").alias("search_item")).agg(
        F.max_by("b1name", "id").alias("b1_category")
    )
    by_category = comparison.groupBy(F.col("category_name").alias("b1_category")).agg(
        F.min_by("search_category", "id").alias("searchCategory")
    )
    return joins.lookup_join(by_name, by_category, "b1_category").select(
        "search_item", "b1_category", "searchCategory"
    )


def add_search_category(pages: DataFrame, keywords: DataFrame) -> DataFrame:
    """Add b1_category and searchCategory by the whole ``search_item`` text."""
    return joins.lookup_join(pages, keywords, "search_item")


def add_order_names(orders: DataFrame, names: DataFrame, overrides: DataFrame) -> DataFrame:
    """Add bcname and btname by sku; a row of ``overrides`` for the order replaces them."""
    by_sku = joins.lookup_join(orders, names.withColumn("sku_id", F.col("sku_id").cast("string")), "sku_id")
    second = overrides.select(
        "order_id",
        F.col("base_trademark_name").alias("_btname"),
        F.col("base_category_name").alias("_bcname"),
    )
    both = joins.lookup_join(by_sku, second, "order_id")
    return both.withColumns(
        {"btname": F.coalesce("_btname", "btname"), "bcname": F.coalesce("_bcname", "bcname")}
    ).drop("_btname", "_bcname")
