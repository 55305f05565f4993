"""The named queries of the operators, over their whole tables, and the SQL that gives the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, decontaminate, lines, paragraphs, pieces, preferences, quality, ranked, secrets, simhash, suffix_tree, urls, whitening,
)
from tidemark.llm.sql import CHECKS as CHECKS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: The listed rules.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


@query
def op1_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL judged by the list, then by rules mined from the labels of the documents behind the pages.

    A page's URL ends in the number of its document; toxic documents are the bad ones.
    """
    pages = table(spark, folder, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.path(F.col("url")), r"/(\d+)[^/]*/?$", 1)
    labels = table(spark, folder, "labels").groupBy("doc_id").agg((F.max("toxic") == 1).alias("bad"))
    numbered = pages.withColumn("n", number).selectExpr("url", "try_cast(n AS bigint) AS doc_id")
    labelled = numbered.join(labels, "doc_id").select("url", "bad")
    judged = urls.judged(pages, urls.mined(labelled, certain=urls.CERTAIN), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule", "confidence")


@query
def op4_preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations two by two, the one with the even number chosen."""
    turns = table(spark, folder, "conversations")
    return preferences.segments(turns, F.floor(F.col("conv_id") / 2), F.col("conv_id") % 2 == 0)


@query
def op5_line_first_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    names = [n for n, _ in quality.FIGURES if n != "clean_text"]
    return quality.judged(docs).select("doc_id", *[F.col(f"quality.{n}") for n in names])


@query
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.tokenized(docs).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(table(spark, folder, "documents"))


@query
def op10_suffix_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored; those whose number's checksum leaves 2 are held out of training."""
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return suffix_tree.scored(docs, held_out)


@query
def op2_repeated_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated(table(spark, folder, "documents")).drop("tie")


@query
def op3_benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op9_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.repeated(table(spark, folder, "documents")).drop("tie")


@query
def op6_secret_findings(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scanned(table(spark, folder, "documents"))


@query
def op11_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.tokenized(docs).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_sketch_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings").select("vec_id", "embedding")).drop("embedding")
