"""Run named queries on Spark and their SQL on DuckDB, and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "null" if value is None else str(value)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
}


def differences(df, db, sql: str) -> list[str]:
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)} sql {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != types[name]:
            found.append(f"type of {name}: spark {kind} sql {types[name]}")
    order = sorted(names)
    at = [names.index(n) for n in order]
    want = Counter(tuple(cell(r[i]) for i in at) for r in expected)
    have = Counter(tuple(cell(x) for x in r) for r in df.select(*order).collect())
    if want != have:
        extra, missing = have - want, want - have
        found.append(f"rows: spark {have.total()} sql {want.total()} extra {extra.total()} missing {missing.total()}")
        found.append(f"  {order}\n  extra   {list(extra)[:2]}\n  missing {list(missing)[:2]}")
    elif not want:
        found.append("no rows")
    return found


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    folder = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duck(folder)
    queries, checks = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            found = differences(df, db, checks[name]) if name in checks else [] if df.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.1f}s", *found, sep="\n    " if found else " ", flush=True)
    print("bad:", bad)
