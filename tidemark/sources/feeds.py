"""Feeds of JSON text, from topics or files, in batch or as streams."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.functions.text import to_json_row


@dataclass(frozen=True)
class Location:
    """Where a feed is: the same value names it for its writer and its readers."""

    format: str
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def topic(servers: str, name: str, start: str = "earliest", **options: str) -> Location:
    """A topic read from the ``earliest`` or ``latest`` offset, or from offsets given as JSON."""
    base = {"kafka.bootstrap.servers": servers, "subscribe": name, "startingOffsets": start}
    return Location("kafka", None, {**base, **options})


def folder(path: str, format: str = "text", **options: str) -> Location:
    return Location(format, path, options)


def text_feed(spark: SparkSession, location: Location, streaming: bool = False) -> DataFrame:
    """The feed's non-null texts as ``value``."""
    reader = (spark.readStream if streaming else spark.read).format(location.format).options(**location.options)
    if location.format not in ("kafka", "text"):
        reader = reader.schema("value STRING")
    rows = reader.load(location.path) if location.path else reader.load()
    value = F.col("value").cast("string")
    return rows.select(value.alias("value")).filter(F.col("value").isNotNull())


def change_feed(
    spark: SparkSession, location: Location, snapshots: Mapping[str, DataFrame] | None = None,
    database: str = "", snapshot_ts: Column | None = None,
) -> DataFrame:
    """Batch change feed: rows of static tables as snapshot events, then the recorded changes."""
    changes = cdc.parse_envelope(text_feed(spark, location))
    at = F.lit(0) if snapshot_ts is None else snapshot_ts
    for name, rows in (snapshots or {}).items():
        changes = cdc.bootstrap(rows, database, name, at).unionByName(changes)
    return changes


def write_snapshot(rows: DataFrame, database: str, name: str, ts_ms: Column, path: str) -> None:
    """Put a table's snapshot events into a feed folder, for streams to read before the changes."""
    to_json_row(cdc.bootstrap(rows, database, name, ts_ms)).write.mode("append").text(path)


def json_lines(
    spark: SparkSession, path: str, schema: str, modified_after: str | None = None, streaming: bool = False
) -> DataFrame:
    """JSON lines of a folder; ``modified_after`` (UTC) skips older files at listing time."""
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    return reader.json(path)


def feed_view(name: str, rows: DataFrame) -> None:
    """Name a parsed feed for SQL."""
    rows.createOrReplaceTempView(name)
