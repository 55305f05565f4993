"""Writers to files. Re-running one gives the same files, so a lost executor or batch does no harm."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.text import to_json_row
from tidemark.operators import cdc
from tidemark.sources import dimensions


@dataclass(frozen=True)
class Layout:
    """Where a table goes and whether it is partitioned by a field."""

    url: str
    partitioned: bool = False
    mode: str = "overwrite"
    field: str | None = None
    format: str = "parquet"


def write_table(rows: DataFrame, layout: Layout) -> None:
    """Write a table in its layout.

    A partitioned table is rebalanced first: few files per value, and a value with most of the rows is
    split over tasks.
    """
    if not layout.partitioned:
        rows.write.mode(layout.mode).format(layout.format).save(layout.url)
        return
    rebalanced = rows.hint("rebalance", F.col(layout.field))
    rebalanced.write.mode(layout.mode).format(layout.format).partitionBy(layout.field).save(layout.url)


def write_routed(rows: DataFrame, url: str, target: str = "sink_table") -> None:
    """One folder per target, as a routed topic writer has one topic per target."""
    write_table(rows, Layout(url, partitioned=True, field=target))


def write_text(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line."""
    to_json_row(rows).write.mode(mode).text(path)


def stream_text(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return to_json_row(rows).writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)


def batch_folders(path: str, format: str = "json") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: each batch has its own folder, overwritten when the batch is retried."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").format(format).save(f"{path}/batch={batch_id}")

    return write


def dimension_versions(
    path: str, key: str, columns: Sequence[str], order: Sequence[str]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: each batch of changes makes the next version of a dimension.

    A batch always starts from the newest version below its own, so a retried batch gives the same rows.
    Versions are numbered from 1; version 0 is the snapshot.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        before = dimensions.current_version(changes.sparkSession, path, below=version)
        after = cdc.apply_changes(before, changes, key, columns, order)
        after.write.mode("overwrite").parquet(f"{path}/version={version}")

    return write


def console(rows: DataFrame, checkpoint: str | None = None) -> DataStreamWriter:
    writer = rows.writeStream.format("console").option("truncate", "false")
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer
