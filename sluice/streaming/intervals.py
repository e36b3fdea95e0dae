"""Exact de-dup of re-delivered records with bounded state.

The state is the set of offsets already delivered, kept as intervals: a table of (topic,
partition, lo, hi) with as many rows as the log partitions have gaps, however many
records they had. Each epoch writes the whole set, made from the set of the epoch before
it, to its own ``_epoch`` folder: an epoch that is replayed after a failure starts from the same set and gives
the same rows, late batches are checked like any other, and no watermark is needed.
Sets that no replay can need any more (older than the epoch before) are removed.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import dedup
from sluice.operators.intervals import merge_intervals, not_in, offset_intervals

SCHEMA = "topic string, partition int, lo long, hi long"


class IntervalStore:
    """The sets of delivered offsets of one landing target, by epoch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def _fs(self):
        return self._hadoop(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def epochs(self) -> list[int]:
        """Epochs whose set is complete."""
        fs = self._fs()
        if not fs.exists(self._hadoop(self.path)):
            return []
        found = []
        for s in fs.listStatus(self._hadoop(self.path)):
            m = re.fullmatch(r"_?epoch=(\d+)", s.getPath().getName())
            if m and fs.exists(self._hadoop(f"{self.path}/{s.getPath().getName()}/_SUCCESS")):
                found.append(int(m[1]))
        return sorted(found)

    def before(self, epoch: int) -> DataFrame | None:
        """The set that ``epoch`` starts from; None if there is none yet."""
        earlier = [e for e in self.epochs() if e < epoch]
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/epoch={earlier[-1]}") if earlier else None

    def write(self, epoch: int, delivered: DataFrame, start: DataFrame | None) -> None:
        """The set after ``epoch``: what it started from and the offsets it delivered."""
        ranges = offset_intervals(delivered).selectExpr("topic", "cast(partition as int) partition", "lo", "hi")
        if start is not None:
            ranges = merge_intervals(start.select("topic", "partition", "lo", "hi").unionByName(ranges))
        ranges.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
        fs = self._fs()
        for e in [e for e in self.epochs() if e < epoch][:-1]:
            fs.delete(self._hadoop(f"{self.path}/epoch={e}"), True)


def unseen(batch: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The first delivery of each record of a batch that no earlier epoch delivered."""
    new = dedup.keep_first(batch, ("topic", "partition", "offset"), order=("push_time",))
    return not_in(new, seen) if seen is not None else new


def dedup_batch(batch: DataFrame, epoch: int, target: str, store: IntervalStore) -> None:
    """``foreachBatch`` body: write the records not delivered before, then the new set."""
    start = store.before(epoch)
    path = f"{target.rstrip('/')}/_epoch={epoch}"
    unseen(batch, start).write.mode("overwrite").parquet(path)
    written = store.spark.read.schema(batch.schema).parquet(path)
    store.write(epoch, written.select("topic", "partition", "offset"), start)


def start_dedup(stream: DataFrame, target: str, checkpoint: str, trigger: dict | None = None):
    """Start an exact de-dup of a record stream into ``target``."""
    store = IntervalStore(stream.sparkSession, checkpoint.rstrip("/") + "-intervals")
    return (stream.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, epoch: dedup_batch(df, epoch, target, store))
            .trigger(**(trigger or {"processingTime": "2 seconds"})).start())
