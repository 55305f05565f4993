"""Session settings and the shared folder for files that jobs hand over."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def builder(name: str = "tidemark") -> SparkSession.Builder:
    build = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        build = build.config(key, value)
    return build


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, below the warehouse, which tasks write to as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tidemark/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to a new folder in the shared one and read from there, so that they are made once."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
