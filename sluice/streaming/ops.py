"""Other streaming operators: de-dup within a watermark, windowed throughput,
routing fan-out, progress marks and the abort rule."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sluice.operators.shaping import route_topics


def dedup_exact(stream: DataFrame, keys: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """Each key's first delivery, however late and however the input is cut into
    batches. Keys are kept as state without end (use the RocksDB state store); the
    landing sink, which looks keys up in the landed table, needs no such state."""
    return stream.dropDuplicates(list(keys))


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str] = ("topic", "partition", "offset"),
                           event_time: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    """For rates and alerts only: records later than ``delay`` behind the newest
    event time are dropped, first deliveries too. :func:`dedup_exact` loses none.

    Re-deliveries inside ``delay`` of each other are dropped; state for a
    key is kept only until the watermark passes it. Watermarks need a
    TIMESTAMP column, so an NTZ time is cast once here."""
    ts = "__event_ts"
    return (stream.withColumn(ts, F.col(event_time).cast("timestamp"))
            .withWatermark(ts, delay)
            .dropDuplicatesWithinWatermark(list(keys))
            .drop(ts))


def windowed_throughput(stream: DataFrame, event_time: str = "timestamp", window: str = "1 minute",
                        delay: str = "1 minute") -> DataFrame:
    secs = {"second": 1, "minute": 60, "hour": 3600}[window.split()[1].rstrip("s")] * int(window.split()[0])
    ts = F.col(event_time).cast("timestamp")
    return (stream.withColumn("__ts", ts).withWatermark("__ts", delay)
            .groupBy(F.window("__ts", window).alias("w"), "topic")
            .agg(F.count(F.lit(1)).alias("n_records"))
            .select(F.col("w.start").alias("window_start"), "topic", "n_records",
                    (F.col("n_records") / secs).alias("records_per_sec")))


def fan_out(batch: DataFrame, mapping: str, base_path: str, epoch: int = 0) -> None:
    """Write one micro-batch to its target tables: one partitioned write
    (``_epoch=.../target_table=...`` folders), not one job per table. The epoch's
    folders are replaced, so a batch replayed after a failure adds no rows."""
    routed = batch.withColumn("target_table", route_topics(F.col("topic"), mapping))
    (routed.withColumn("_epoch", F.lit(epoch).cast("long"))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("_epoch", "target_table").parquet(base_path))


class ProgressMarks(StreamingQueryListener):
    """Calls ``mark(total_rows)`` each time another ``every`` input rows have
    been processed (the producer's "sent N rows" marks)."""

    def __init__(self, every: int, mark: Callable[[int], None]):
        self.every, self.mark, self.total, self.next = every, mark, 0, every

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.total += int(event.progress.numInputRows)
        while self.total >= self.next:
            self.mark(self.next)
            self.next += self.every

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def stop_on_abort(query, state, poll_seconds: float = 0.5, timeout_seconds: float = 60.0) -> bool:
    """Poll the landing state; stop the query when the error count grew since
    the previous batch (the monitor's abort rule). Returns True if aborted."""
    import time
    deadline = time.time() + timeout_seconds
    while query.isActive and time.time() < deadline:
        if state.abort:
            query.stop()
            return True
        time.sleep(poll_seconds)
    return state.abort
