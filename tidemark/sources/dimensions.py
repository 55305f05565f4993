"""Dimension tables: from a database by SQL text, or from files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.text import camel_case_columns


def from_query(
    spark: SparkSession, query: str, options: Mapping[str, str], camel_case: bool = False, format: str = "jdbc"
) -> DataFrame:
    """Rows of a SQL query, columns named by their aliases.

    ``options`` hold url, user and password as the caller got them from its environment. A large table is
    read in parallel with ``dbtable`` and ``partitionColumn`` options in place of a query.
    """
    reader = spark.read.format(format).options(**options)
    if query:
        reader = reader.option("query", query)
    rows = reader.load()
    return camel_case_columns(rows) if camel_case else rows


def from_files(spark: SparkSession, path: str, format: str = "parquet", camel_case: bool = False) -> DataFrame:
    rows = spark.read.format(format).load(path)
    return camel_case_columns(rows) if camel_case else rows


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the ``version=`` folders below ``path``, by listing that one folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [entry.getPath().getName() for entry in store.listStatus(place)]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def current_version(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """The newest version of a versioned dimension folder; no other version is opened."""
    newest = max(v for v in versions(spark, path) if below is None or v < below)
    return spark.read.parquet(f"{path}/version={newest}")


def dimension_view(name: str, rows: DataFrame) -> None:
    """Name a dimension for SQL; joins with it are planned by size like any other."""
    rows.createOrReplaceTempView(name)
