"""Writers to topics. ``value`` is the text; ``key`` and ``topic`` columns are used where present."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.text import to_json_row


def options(servers: str, topic: str | None = None, durable: bool = False) -> dict[str, str]:
    """Producer options; ``durable`` waits for all replicas and writes each record once per producer."""
    chosen = {"kafka.bootstrap.servers": servers}
    if topic:
        chosen["topic"] = topic
    if durable:
        chosen |= {
            "kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.retries": str(2**31 - 1),
        }
    return chosen


def stream(
    rows: DataFrame, servers: str, topic: str, checkpoint: str, durable: bool = False
) -> DataStreamWriter:
    """Rows as JSON text to one topic, at least once."""
    return (
        to_json_row(rows).writeStream.format("kafka").options(**options(servers, topic, durable))
        .option("checkpointLocation", checkpoint)
    )


def batch(rows: DataFrame, servers: str, topic: str, durable: bool = True) -> DataFrameWriter:
    return to_json_row(rows).write.format("kafka").options(**options(servers, topic, durable))


def routed(rows: DataFrame, target: str = "sink_table") -> DataFrame:
    """Rows with the topic each goes to, for a topic writer without a fixed topic."""
    payload = [c for c in rows.columns if c != target]
    return rows.select(F.col(target).alias("topic"), F.to_json(F.struct(*payload)).alias("value"))


def upsert(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows as key and value JSON, for a topic in which the last value per key counts."""
    return rows.select(F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct("*")).alias("value"))
