"""Incremental indexes over a stream of new files or events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.state import upsert
from ..sources.files import children, delete_path

BUCKETS = 64
#: Manifests that stay readable; a batch that is run again needs the one before it.
KEPT = 2


class BucketedIndex:
    """A keyed table of which a batch rewrites only the buckets that it touches.

    Rows lie by a hash of their keys in data/v<batch>/bucket=<b>.  A manifest for each
    batch says which batch wrote each bucket last; it is written after the data and is one
    file, so readers see a batch whole or not at all, and a batch that is run again
    writes the same files once more.  Buckets that no kept manifest names are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    def _bucket(self):
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def _manifest(self, batch: int) -> dict[int, int]:
        """Bucket to batch, at most one entry a bucket."""
        if batch < 0:
            return {}
        rows = self.spark.read.schema("bucket int, batch long").json(f"{self.path}/manifest/v{batch}").collect()
        return {r.bucket: r.batch for r in rows}

    def _folders(self, manifest: dict[int, int]) -> list[str]:
        return [f"{self.path}/data/v{n}/bucket={b}" for b, n in sorted(manifest.items())]

    def apply(self, events: DataFrame, batch: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Merge the events into the index as batch number `batch`, counted from 0; merge(old, new) gives the new rows."""
        events = events.dropna(subset=self.keys).withColumn("bucket", self._bucket()).persist()
        before = self._manifest(batch - 1)
        touched = sorted(r.bucket for r in events.select("bucket").distinct().collect())
        old = {b: before[b] for b in touched if b in before}
        new = events.drop("bucket")
        held = self.spark.read.parquet(*self._folders(old)) if old else None
        rows = merge(new.limit(0) if held is None else held, new)
        if touched:
            rows = rows.withColumn("bucket", self._bucket()).repartition("bucket")
            rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/v{batch}")
        after = before | dict.fromkeys(touched, batch)
        manifest = self.spark.createDataFrame(sorted(after.items()), "bucket int, batch long").coalesce(1)
        manifest.write.mode("overwrite").json(f"{self.path}/manifest/v{batch}")
        events.unpersist()
        self._expire(batch, before, after)

    def _expire(self, batch: int, before: dict[int, int], after: dict[int, int]) -> None:
        gone = batch - KEPT
        if gone < 0:
            return
        kept = set(before.items()) | set(after.items())
        stale = {b: n for b, n in self._manifest(gone).items() if (b, n) not in kept}
        for folder in self._folders(stale):
            delete_path(self.spark, folder)
        delete_path(self.spark, f"{self.path}/manifest/v{gone}")

    def read(self) -> DataFrame | None:
        """The rows of the last whole batch, None before the first."""
        # Spark marks a folder once all of it is written.
        whole = [n for n in children(self.spark, f"{self.path}/manifest") if "_SUCCESS" in children(self.spark, f"{self.path}/manifest/{n}")]
        manifest = self._manifest(max((int(n[1:]) for n in whole), default=-1))
        return self.spark.read.parquet(*self._folders(manifest)) if manifest else None


def upsert_stream(events: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep a bucketed index of the latest event of each key under path."""
    index = BucketedIndex(events.sparkSession, path, keys, buckets)

    def apply(batch: DataFrame, n: int) -> None:
        index.apply(batch, n, lambda old, new: upsert(old, new, keys, order))

    return each_batch(events, apply, checkpoint)


def windowed_counts(events: DataFrame, time: str, by: str, length: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events per window and kind, with late ones up to a watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, length), by).agg(F.count("*").alias("n"))


def each_batch(events: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return events.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
