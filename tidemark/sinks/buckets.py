"""Dimensions kept in hash buckets: a batch of changes rewrites only the buckets that it touches.

Below the dimension's folder, ``data/version=N/bucket=B`` has the rows of a bucket as version N left them, and
``manifests/version=N`` names for every bucket the version whose rows are current. A version counts once its manifest is
written, so a batch that is broken off or retried does no harm. Readers keep what they have opened: versions are removed
only when none of the newest manifests names them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.sources.dimensions import versions

BUCKET = "bucket"
BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


class Dimension:
    """A bucketed dimension with rows unique by ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, columns: Sequence[str]):
        self.spark, self.path, self.key, self.columns = spark, path.rstrip("/"), key, list(columns)

    # Files.

    def place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        place, store = self.place(path)
        return store.exists(place)

    def remove(self, path: str) -> None:
        place, store = self.place(path)
        store.delete(place, True)

    def listed(self, path: str, prefix: str) -> list[int]:
        place, store = self.place(path)
        names = [e.getPath().getName() for e in store.listStatus(place)] if store.exists(place) else []
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    # Manifests.

    def manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/version={version}"

    def written(self) -> list[int]:
        """The versions whose manifest is complete."""
        return [v for v in versions(self.spark, f"{self.path}/manifests") if self.exists(f"{self.manifest_path(v)}/_SUCCESS")]

    def manifest(self, version: int) -> dict:
        return json.loads(self.spark.read.text(self.manifest_path(version)).first()["value"])

    def commit(self, version: int, manifest: dict) -> None:
        text = self.spark.createDataFrame([(json.dumps(manifest),)], "value STRING")
        text.coalesce(1).write.mode("overwrite").text(self.manifest_path(version))

    # Rows.

    def write(self, rows: DataFrame, version: int, buckets: int) -> list[int]:
        """Write rows by bucket; a bucket with most of them is split over tasks. Returns the buckets that have rows."""
        placed = rows.select(self.key, *self.columns, bucket_of(self.key, buckets).alias(BUCKET))
        path = f"{self.path}/data/version={version}"
        placed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        return self.listed(path, f"{BUCKET}=")

    def create(self, rows: DataFrame, buckets: int = BUCKETS) -> None:
        """The dimension's first version, 0."""
        schema = rows.select(self.key, *self.columns).schema.json()
        filled = self.write(rows, 0, buckets)
        self.commit(0, {"buckets": buckets, "schema": schema, "current": {str(b): 0 for b in filled}})

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version, the newest if not said; of some buckets only, if said. No other file is opened."""
        from pyspark.sql.types import StructType

        manifest = self.manifest(self.written()[-1] if version is None else version)
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        wanted = {int(b): v for b, v in manifest["current"].items() if only is None or int(b) in only}
        folders = [f"{self.path}/data/version={v}/{BUCKET}={b}" for b, v in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def apply(self, changes: DataFrame, version: int, order: Sequence[str]) -> list[int]:
        """The next version after changes (see ``cdc.apply_changes``); returns the buckets that were written anew.

        The version before is the newest one below, so a retried batch gives the same rows. The driver gets the numbers of
        the touched buckets, of which there are as many as the dimension has at most.
        """
        before = max(v for v in self.written() if v < version)
        manifest = self.manifest(before)
        buckets = manifest["buckets"]
        known = changes.filter(F.col(self.key).isNotNull())
        touched = [r[BUCKET] for r in known.select(bucket_of(self.key, buckets).alias(BUCKET)).distinct().collect()]
        if touched:
            after = cdc.apply_changes(self.read(before, touched), known, self.key, self.columns, order)
            filled = self.write(after, version, buckets)
            manifest["current"] = {b: v for b, v in manifest["current"].items() if int(b) not in touched} | {str(b): version for b in filled}
        self.commit(version, manifest)
        return sorted(touched)

    def clean(self, keep: int = 3) -> None:
        """Remove all but the ``keep`` newest manifests, and the rows that none of the kept ones names."""
        known = self.written()
        kept = known[-max(keep, 2) :]
        named = {(v, int(b)) for n in kept for b, v in self.manifest(n)["current"].items()}
        for version in [v for v in known if v not in kept]:
            self.remove(self.manifest_path(version))
        for version in self.listed(f"{self.path}/data", "version="):
            # Rows above the newest manifest may be a batch at work.
            if version > kept[-1]:
                continue
            folder = f"{self.path}/data/version={version}"
            for bucket in self.listed(folder, f"{BUCKET}="):
                if (version, bucket) not in named:
                    self.remove(f"{folder}/{BUCKET}={bucket}")
            if not self.listed(folder, f"{BUCKET}="):
                self.remove(folder)


def bucketed_versions(dimension: Dimension, order: Sequence[str], keep: int = 3) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: each batch of changes makes the next version, and versions that are too old go."""

    def write(changes: DataFrame, batch_id: int) -> None:
        # Found out twice, which buckets and with what, so the batch is read once and kept.
        changes.persist()
        try:
            dimension.apply(changes, batch_id + 1, order)
        finally:
            changes.unpersist()
        dimension.clean(keep)

    return write
