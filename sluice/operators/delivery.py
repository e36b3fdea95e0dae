"""Delivery bookkeeping: committed offsets, resume points, commit waits and
the row-error cap."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.casts import token_to_long
from sluice.functions.sizing import bounded_broadcast

# A progress table has one row per log partition; this bounds it.
MAX_PARTITIONS = 100_000


def committed_offsets(landed: DataFrame, keys: Sequence[str] = ("topic", "partition"),
                      offset: str = "offset") -> DataFrame:
    """Commit after confirm: the next offset to read per partition is the
    highest landed offset + 1 (a partial aggregate)."""
    return (landed.groupBy(*keys)
            .agg((F.max(offset) + 1).cast("bigint").alias("next_offset"),
                 F.count(F.lit(1)).alias("landed_rows")))


def advanced_commits(status: DataFrame, channel: str = "channel", ts: str = "poll_ts",
                     token: str = "committed_token") -> DataFrame:
    """Emit a commit only when the committed token is not NULL and differs
    from the last token committed before (polls with a NULL token commit
    nothing and do not reset it); the commit offset is token + 1 (NULL if
    the token is not numeric)."""
    earlier = Window.partitionBy(channel).orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(token, ignorenulls=True).over(earlier)
    return (status.select(channel, ts, token, prev.alias("__prev"))
            .where(F.col(token).isNotNull() & ~F.col(token).eqNullSafe(F.col("__prev")))
            .select(channel, ts, token,
                    (token_to_long(F.col(token)) + 1).alias("commit_offset")))


def resume_from_committed(records: DataFrame, progress: DataFrame,
                          keys: Sequence[str] = ("topic", "partition")) -> DataFrame:
    """Records still to deliver: past the committed offset, or all of them
    when the partition never committed (start at earliest). The progress table
    is one row per partition, so it is broadcast behind a size check."""
    p = bounded_broadcast(progress.select(*keys, "committed"), MAX_PARTITIONS)
    return (records.join(p, list(keys), "left")
            .where(F.col("committed").isNull() | (F.col("offset") > F.col("committed"))))


def resume_points(records: DataFrame, progress: DataFrame,
                  keys: Sequence[str] = ("topic", "partition")) -> DataFrame:
    pending = resume_from_committed(records, progress, keys)
    return (pending.groupBy(*keys)
            .agg(F.min("offset").alias("resume_offset"),
                 F.count(F.lit(1)).alias("pending_rows"),
                 F.first("committed", ignorenulls=True).alias("committed")))


def commit_wait(status: DataFrame, start_ts: Column, timeout_hours: int,
                channel: str = "channel", ts: str = "poll_ts") -> DataFrame:
    """Wait for commit: the target is the highest sent offset at ``start_ts``;
    the wait ends at the first poll whose committed token reaches it. It is
    ``committed`` when that happens within the timeout, else ``timed_out``."""
    tok = token_to_long(F.col("committed_token"))
    targets = (status.where(F.col(ts) <= start_ts).groupBy(channel)
               .agg(F.max("sent_offset").alias("target_offset")))
    reached = (status.join(targets, channel)
               .where((F.col(ts) >= start_ts) & (tok >= F.col("target_offset")))
               .groupBy(channel).agg(F.min(ts).alias("committed_at")))
    deadline = F.timestamp_add("HOUR", F.lit(timeout_hours), start_ts)
    return (targets.join(reached, channel, "left")
            .select(channel, "target_offset", "committed_at",
                    F.when(F.col("committed_at") <= deadline, F.lit("committed"))
                     .otherwise(F.lit("timed_out")).alias("wait_status")))


def error_cap(validated: DataFrame, max_errors: int = 5,
              keys: Sequence[str] = ("topic", "partition"), offset: str = "offset",
              block_size: int = 1 << 16) -> DataFrame:
    """A producer stops after its ``max_errors``-th failed row. Per partition:
    the offset where it stopped (NULL if it never did), the rows sent up to
    there, and the errors seen.

    One pass, exact, with no partition-wide window: rows are windowed per
    (partition, offset block) -- a hot partition is cut into bounded blocks --
    to get each error's position and error rank inside its block; the same
    partitioning feeds a per-block aggregate that keeps at most ``k`` error
    entries per block. A prefix over the small block table then locates the
    k-th error of each partition and the rows before it.
    """
    k = max_errors
    bad = ~F.col("is_valid")
    slim = validated.select(*keys, offset, "is_valid",
                            F.floor(F.col(offset) / block_size).alias("__blk"))
    w = Window.partitionBy(*keys, "__blk").orderBy(offset)
    ranked = slim.select(
        *keys, "__blk", offset, "is_valid",
        F.row_number().over(w).alias("__pos"),
        F.sum(bad.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         .alias("__erank"))
    blocks = (ranked.groupBy(*keys, "__blk")
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_if(bad).alias("n_err"),
                   F.collect_list(F.when(bad & (F.col("__erank") <= k),
                                         F.struct(F.col("__erank").alias("r"), F.col(offset).alias("o"),
                                                  F.col("__pos").alias("p")))).alias("firsts")))
    before = Window.partitionBy(*keys).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    b = blocks.select(*keys, "n_rows", "n_err", "firsts",
                      F.coalesce(F.sum("n_err").over(before), F.lit(0)).alias("err_before"),
                      F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("rows_before"))
    is_stop = (F.col("err_before") < k) & (F.col("err_before") + F.col("n_err") >= k)
    hit = F.element_at(F.filter("firsts", lambda x: x["r"] == F.lit(k) - F.col("err_before")), 1)
    per = b.select(*keys, "n_rows", "n_err",
                   F.when(is_stop, hit["o"]).alias("stop_offset"),
                   F.when(is_stop, F.col("rows_before") + hit["p"]).alias("rows_at_stop"))
    return (per.groupBy(*keys)
            .agg(F.max("stop_offset").alias("stop_offset"),
                 F.coalesce(F.max("rows_at_stop"), F.sum("n_rows")).cast("bigint").alias("rows_sent"),
                 F.least(F.lit(k).cast("bigint"), F.sum("n_err")).cast("bigint").alias("errors_seen")))
