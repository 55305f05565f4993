"""Change-feed rows: parse, select, flatten, route, and apply to a snapshot."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import dedup, joins

DELETE = "d"
SNAPSHOT = "r"


def parse(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """JSON text to typed columns; text that does not parse gives nulls.

    ``inline`` keeps later filters above the parser. Pushed below a plain projection they would carry the
    parser with them, and each text would be parsed once more per filter.
    """
    return df.select(F.inline(F.array(F.from_json(value, schema))))


def parse_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Change envelopes with the changed row still as text."""
    return parse(df.filter(F.col(value).isNotNull()), schemas.ENVELOPE, value).filter(
        F.col("source.table").isNotNull()
    )


def parse_page_log(df: DataFrame, value: str = "value") -> DataFrame:
    return parse(df.filter(F.col(value).isNotNull()), schemas.PAGE_LOG, value).filter(F.col("common").isNotNull())


def table(envelopes: DataFrame, name: str, schema: str | None = None) -> DataFrame:
    """Live rows of one table, with ``after`` parsed only now that other tables are filtered out."""
    schema = schemas.TABLES[name] if schema is None else schema
    return (
        envelopes.filter((F.col("source.table") == name) & (F.col("op") != DELETE) & F.col("after").isNotNull())
        .withColumn("after", F.from_json("after", schema))
    )


def split_tables(envelopes: DataFrame, path: str) -> Callable[[str], DataFrame]:
    """Write all tables of a change feed, each to a folder of its own, in one job; the result reads a table's live rows.

    The envelope text is parsed once for all of them, deletes are left out on the way, and a reader opens the files of its
    table only and parses ``after`` there. A table with most of the changes is written by many tasks.
    """
    rows = envelopes.filter((F.col("op") != DELETE) & F.col("after").isNotNull())
    rows.select(F.col("source.table").alias("table"), "op", "ts_ms", "after").write.mode("overwrite").partitionBy("table").parquet(path)
    stored = envelopes.sparkSession.read.schema("op STRING, ts_ms BIGINT, after STRING, table STRING").parquet(path)

    def read(name: str) -> DataFrame:
        found = stored.filter(F.col("table") == name).drop("table")
        return found.withColumn("after", F.from_json("after", schemas.TABLES[name]))

    return read


def live(changes: DataFrame) -> DataFrame:
    """Parsed changes of one table without deletes."""
    return changes.filter((F.col("op") != DELETE) & F.col("after").isNotNull())


def flatten(df: DataFrame, key: str = "key", topic: str = "topic") -> DataFrame:
    """One flat row per change: id, op, database, tableName, before, after, ts.

    ``id`` is the key and the change time; database and table come from a three-part topic name.
    """
    parts = F.split(F.col(topic), "\\.")
    part = lambda i: F.when(F.size(parts) == 3, F.get(parts, F.lit(i)))
    return df.select(
        F.concat_ws("_", F.col(key).cast("string"), F.col("ts_ms").cast("string")).alias("id"),
        "op",
        part(1).alias("database"),
        part(2).alias("tableName"),
        "before",
        "after",
        F.col("ts_ms").cast("string").alias("ts"),
    )


def bootstrap(rows: DataFrame, database: str, name: str, ts_ms: Column) -> DataFrame:
    """Rows of a static table as snapshot envelopes, to be unioned in front of its change feed."""
    payload = rows.select(F.to_json(F.struct("*")).alias("after"), ts_ms.cast("bigint").alias("_ts"))
    return payload.select(
        F.lit(None).cast("string").alias("before"),
        "after",
        F.struct(
            F.lit(database).alias("db"), F.lit(name).alias("table"), F.col("_ts").alias("ts_ms")
        ).alias("source"),
        F.lit(SNAPSHOT).alias("op"),
        F.col("_ts").alias("ts_ms"),
    )


def route(envelopes: DataFrame, routes: DataFrame) -> DataFrame:
    """Send each change to its configured sink with only the configured columns.

    Tables without a route are dropped. The routing table goes through the checked lookup join. Values keep
    their JSON types.
    """
    config = routes.select(
        F.col("sourceTable").alias("_source"), "sinkTable", "sinkColumns", "op"
    ).filter(F.col("op") != DELETE).drop("op")
    typed = envelopes.withColumn("_source", F.col("source.table"))
    matched = joins.lookup_join(typed, config, "_source").filter(F.col("sinkTable").isNotNull())
    fields = F.from_json(F.coalesce("after", "before"), "map<string,variant>")
    wanted = F.transform(F.split("sinkColumns", ","), lambda c: F.trim(c))
    kept = F.map_filter(fields, lambda k, _: F.array_contains(wanted, k))
    return matched.select(
        F.col("sinkTable").alias("sink_table"), "op", "ts_ms", F.to_json(kept).alias("value")
    )


def apply_changes(
    snapshot: DataFrame, changes: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """A dimension after its changes: upsert by key, delete by key, null columns leave the old value.

    ``changes`` has ``op`` and the ``order`` columns. One aggregate per key finds the last delete and, per
    column, the last written value; a value counts when it was written after the last delete.
    """
    old = snapshot.select(
        key, *columns, F.lit(SNAPSHOT).alias("op"),
        *[F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in order],
    )
    rows = old.unionByName(changes.select(key, *columns, "op", *order))
    at = F.struct(*order)
    is_delete = F.col("op") == DELETE
    per_key = rows.groupBy(key).agg(
        F.max(F.when(is_delete, at)).alias("_deleted"),
        F.max(F.when(~is_delete, at)).alias("_written"),
        *[
            F.max(F.when(~is_delete & F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("value"))))
            .alias(f"_{c}")
            for c in columns
        ],
    )
    since_delete = lambda moment: F.col("_deleted").isNull() | (moment > F.col("_deleted"))
    return per_key.filter(since_delete(F.col("_written"))).select(
        key, *[F.when(since_delete(F.col(f"_{c}.at")), F.col(f"_{c}.value")).alias(c) for c in columns]
    )


def latest_per_key(changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last value per key of an upsert topic, without keys whose last change is a delete."""
    return dedup.latest(changes, key, order).filter(F.col("op") != DELETE)


def union_feeds(**feeds: DataFrame) -> DataFrame:
    """All label feeds as text, each line with the feed it came from."""
    merged = None
    for name, feed in feeds.items():
        lines = feed.select("value", F.lit(name).alias("source"))
        merged = lines if merged is None else merged.unionByName(lines)
    return merged
