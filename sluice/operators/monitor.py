"""Monitoring over the channel status history (one row per channel per poll)
and over landed records.

The history is small next to the data (one row per channel per poll), so
per-channel windows over it are cheap; anything over raw records is a
grouped aggregate.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.casts import token_to_long
from sluice.functions.timefn import from_epoch_millis, lit_ntz, trunc_ntz

CH, TS = "channel", "poll_ts"


def _w(channel: str = CH, ts: str = TS):
    return Window.partitionBy(channel).orderBy(ts)


def status_rollup(validated: DataFrame, channel: Column) -> DataFrame:
    """Channel status from validated rows: inserted rows, error rows, the last
    error message and the highest offset that had an error."""
    err = ~F.col("is_valid")
    reason = F.element_at("error_reasons", 1)
    return (validated.groupBy(channel.alias("channel"))
            .agg(F.count_if(F.col("is_valid")).alias("rows_inserted_count"),
                 F.count_if(err).alias("rows_error_count"),
                 F.max_by(F.when(err, reason), F.when(err, F.col("offset"))).alias("last_error_message"),
                 F.max(F.when(err, F.col("offset"))).cast("string")
                  .alias("last_error_offset_token_upper_bound"),
                 F.max("offset").cast("string").alias("latest_offset_token")))


def offset_lag(status: DataFrame) -> DataFrame:
    """lag = highest offset sent so far (starting at 0, never shrinking) minus
    the committed token; NULL when the token is missing or not numeric."""
    run = _w().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sent = F.greatest(F.lit(0), F.max("sent_offset").over(run)).cast("bigint")
    return status.select(CH, TS, sent.alias("sent_highest"), "committed_token",
                         (sent - token_to_long(F.col("committed_token"))).alias("offset_lag"))


def error_growth(status: DataFrame) -> DataFrame:
    """Abort when the error count grew since the previous poll; the first poll
    never aborts."""
    prev = F.lag("rows_error_count").over(_w())
    return (status.select(CH, TS, "rows_error_count", prev.alias("prev_error_count"))
            .withColumn("abort", F.coalesce(F.col("rows_error_count") > F.col("prev_error_count"),
                                            F.lit(False))))


def abort_point(status: DataFrame) -> DataFrame:
    """The first abort per channel; rows after it are never sent, so the next
    unsent offset is the highest sent + 1."""
    g = error_growth(status).join(offset_lag(status).select(CH, TS, "sent_highest"), [CH, TS])
    return (g.where("abort").groupBy(CH)
            .agg(F.min(TS).alias("abort_ts"),
                 F.min_by("sent_highest", F.col(TS)).alias("sent_highest"))
            .withColumn("next_unsent_offset", F.col("sent_highest") + 1))


def ingestion_lag(status: DataFrame) -> DataFrame:
    """latest-consumer-offset minus the persisted (committed) offset."""
    return status.select(CH, TS, "latest_consumer_offset",
                         token_to_long(F.col("committed_token")).alias("persisted_offset"),
                         (F.col("latest_consumer_offset") - token_to_long(F.col("committed_token")))
                         .alias("ingestion_lag"))


def metric_growth(status: DataFrame) -> DataFrame:
    """Alert rules: ingestion lag, backpressure rewinds and channel recoveries
    growing since the previous poll."""
    w = _w()
    lag = F.col("latest_consumer_offset") - token_to_long(F.col("committed_token"))
    d = status.select(CH, TS, lag.alias("ingestion_lag"), "backpressure_rewind_count",
                      "channel_recovery_count")
    grow = lambda c: F.coalesce(F.col(c) - F.lag(c).over(w) > 0, F.lit(False))
    return d.select(CH, TS, grow("ingestion_lag").alias("lag_growing"),
                    grow("backpressure_rewind_count").alias("backpressure_growing"),
                    grow("channel_recovery_count").alias("recovery_growing"))


def unhealthy_channels(status: DataFrame, every: str = "30 seconds") -> DataFrame:
    """At each check (end of every ``every`` interval) each channel polled since the last
    one whose latest status is not SUCCESS (or unknown) is listed, also if it heals later."""
    start = F.window(F.col(TS).cast("timestamp"), every).start.cast("timestamp_ntz")
    return (status.groupBy(CH, start.alias("check_period"))
            .agg(F.max_by("status_code", TS).alias("last_status"), F.max(TS).alias("last_poll_ts"))
            .where(~F.col("last_status").eqNullSafe("SUCCESS")))


def throughput(records: DataFrame, ts: str = "timestamp", by: Sequence[str] = ("topic",),
               window: str = "1 hour", seconds: int = 3600) -> DataFrame:
    """Records per tumbling window and the mean rate in records per second."""
    return (records.groupBy(F.window(ts, window).start.cast("timestamp_ntz").alias("window_start"), *by)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .withColumn("records_per_sec", F.round(F.col("n_records") / seconds, 6)))


def assigned_partitions(status: DataFrame) -> DataFrame:
    return (status.groupBy("task_id")
            .agg(F.count_distinct(CH).alias("assigned_partitions")))


def client_leaks(status: DataFrame) -> DataFrame:
    """More clients than target tables suggests clients are leaking."""
    return (status.agg(F.count_distinct("client").alias("clients"),
                       F.count_distinct("target_table").alias("tables"))
            .withColumn("leak_suspected", F.col("clients") > F.col("tables")))


def latency_profile(status: DataFrame) -> DataFrame:
    """Per task: exact p99 of put duration and the mean server latency. Runs
    on the status history (one row per poll), so the exact percentile is
    bounded by the number of polls, not by the data."""
    return (status.groupBy("task_id")
            .agg(F.round(F.percentile("put_duration_ms", 0.99), 3).alias("put_duration_p99"),
                 F.round(F.avg("avg_latency_ms"), 3).alias("avg_latency_ms")))


def record_latency(records: DataFrame, as_of: str) -> DataFrame:
    """Per-record latency: from the connector push time to ``as_of``, in ms."""
    return records.select("topic", "partition", "offset",
                          F.timestamp_diff("MILLISECOND", from_epoch_millis(F.col("push_time")),
                                           lit_ntz(as_of)).alias("latency_ms"))


def slowest(records: DataFrame, as_of: str, n: int = 10) -> DataFrame:
    return (record_latency(records, as_of)
            .orderBy(F.desc("latency_ms"), "topic", "partition", "offset").limit(n))
