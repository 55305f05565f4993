"""What several operators share: checkpoints in the shared folder, shipping of task code, word rules."""

from __future__ import annotations

import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session

#: Words are runs of anything but the ASCII space, tab, line and page feeds.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"


def shipped(name: str) -> None:
    """Send a module's task code with the job, so that executors need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


shipped(__name__)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, for tasks that make many Python objects of each."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there, so that lost executors cost no recomputation.

    The folder is the one of ``spark.checkpoint.dir``; only where that is unset, one below the warehouse is used.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(session.shared_folder(spark))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written and that nothing refers to any more.

    Spark does so when the driver collects garbage, which with little work there may be long after. The last query stays
    referred to until another one has run, hence the small one here.
    """
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stored(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet to a new folder in the shared one and read from there.

    For tables that a checkpoint would make large; the folder stays until the shared one is cleared.
    """
    folder = session.shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Rows of a few numbers that may be sent to all tasks: some 50 MB.
SENT_ROWS = 1 << 20


def looked_up(rows: DataFrame, names: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` that have a match in the narrow, written table ``names``, with its columns.

    ``names`` is counted. Up to ``SENT_ROWS`` it is broadcast, and long texts in ``rows`` stay where they are; a larger one is
    joined by a shuffle.
    """
    return rows.join(F.broadcast(names) if names.count() <= SENT_ROWS else names, on)
