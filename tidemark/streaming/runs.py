"""Starting streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidemark import session
from tidemark.operators import joins

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
#: Counting the rows of a state store costs a look-up per write; a batch need not upload a store that it changed in part.
COUNT_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
TRIGGER = "30 seconds"
CAPTURE_TRIGGER = "3 seconds"


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Set session settings for queries started inside; a query keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start(
    writer: DataStreamWriter, spark: SparkSession, trigger: str | None = TRIGGER, idle: bool = True, count_rows: bool = False
) -> StreamingQuery:
    """Start a query that commits every ``trigger``, or with None reads what is there and ends.

    ``idle`` batches without data close windows. State that expires by processing time asks for them
    forever, so a query with such state that should end is started without. ``count_rows`` has its progress say how many
    rows are in state.
    """
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    stores = {PROVIDER: session.ROCKSDB, COUNT_ROWS: str(count_rows).lower(), CHANGELOG: "true"}
    with settings(spark, **stores, **{IDLE_BATCHES: str(idle).lower()}):
        return timed.start()


def enriched(
    read_dim: Callable[[], DataFrame], on: str, write: Callable[[DataFrame, int], None], prefix: str = ""
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that looks rows up in a dimension read afresh for each batch."""

    def look_up(rows: DataFrame, batch_id: int) -> None:
        write(joins.lookup_join(rows, read_dim(), on, prefix=prefix), batch_id)

    return look_up


def files(rows: DataFrame, folder: str, format: str = "parquet") -> DataStreamWriter:
    """Append rows to files exactly once."""
    return (
        rows.writeStream.format(format).option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint").outputMode("append")
    )


def read_files(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """What another query writes with :func:`files`, as a stream. A watermark can be set anew on it."""
    return spark.readStream.schema(schema).parquet(f"{folder}/rows")


def run_to_files(rows: DataFrame, folder: str, idle: bool = True) -> DataFrame:
    """Run a stream over everything there is now, and read back what it wrote."""
    spark = rows.sparkSession
    start(files(rows, folder), spark, trigger=None, idle=idle).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def run_until_timers_end(rows: DataFrame, folder: str, poll: float = 0.2) -> DataFrame:
    """Run a stream with processing-time timers over what is there now, until all of it is read and no state is left.

    Such a stream never ends by itself, as Spark asks it for idle batches in which timers fire.
    """
    spark = rows.sparkSession
    query = start(files(rows, folder), spark, trigger="0 seconds", count_rows=True)
    try:
        while query.isActive:
            # The first batch after a restart may be one that was broken off, so two in a row must be idle.
            last = query.recentProgress[-2:]
            if len(last) == 2 and not any(p["numInputRows"] or any(s["numRowsTotal"] for s in p["stateOperators"]) for p in last):
                break
            time.sleep(poll)
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def run_with_stops(writer: DataStreamWriter, spark: SparkSession, stops: int, poll: float = 0.05) -> None:
    """Run a query over what is there now, stopped ``stops`` times after a batch, most likely within the next one.

    Each start goes on from the checkpoint; a batch that was broken off is done again.
    """
    for _ in range(stops):
        query = start(writer, spark, trigger="0 seconds")
        while query.isActive and not query.recentProgress:
            time.sleep(poll)
        query.stop()
        if query.exception() is not None:
            raise query.exception()
    start(writer, spark, trigger=None).awaitTermination()
