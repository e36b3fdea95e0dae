"""Sets of offsets as intervals: what a log partition has delivered, in as many rows as
it has gaps (not as many as it has records).

Everything is done in two levels. Runs of consecutive offsets are found within blocks of
``OFFSET_BLOCK`` offsets, so a hot log partition is spread over its blocks; only the runs
(one per block where nothing is missing) are merged per log partition.

Defined cases: re-deliveries count once; a row whose topic, partition or offset is NULL
belongs to no interval and is never taken as seen; empty inputs give empty sets.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of one block.
OFFSET_BLOCK = 1 << 16

KEYS = ("topic", "partition")
RANGE = ("lo", "hi")


def merge_intervals(ranges: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The union of intervals (keys, lo, hi): overlapping and adjacent ones become one."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("lo") > before + 1), 1).otherwise(0)
    return (ranges.select(*keys, *RANGE).withColumn("__starts", starts)
            .withColumn("__run", F.sum("__starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*keys, "__run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__run"))


def offset_intervals(records: DataFrame, keys: Sequence[str] = KEYS, offset: str = "offset",
                     block_size: int = OFFSET_BLOCK) -> DataFrame:
    """The maximal runs (keys, lo, hi) of consecutive offsets of each log partition."""
    present = records.select(*keys, F.col(offset).cast("long").alias("__o")).where(
        F.col("__o").isNotNull() & F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    block = F.floor(F.col("__o") / block_size)
    one = present.groupBy(*keys, "__o").agg(F.count(F.lit(1)).alias("__copies"))
    w = Window.partitionBy(*keys, "__block").orderBy("__o")
    runs = (one.select(*keys, "__o", block.alias("__block"))
            .withColumn("__run", F.col("__o") - F.row_number().over(w))
            .groupBy(*keys, "__block", "__run").agg(F.min("__o").alias("lo"), F.max("__o").alias("hi")))
    return merge_intervals(runs, keys)


def not_in(records: DataFrame, ranges: DataFrame, keys: Sequence[str] = KEYS, offset: str = "offset",
           block_size: int = OFFSET_BLOCK) -> DataFrame:
    """The records whose offset lies in none of the intervals. Intervals are cut at the
    blocks that the records touch, so both sides meet on (keys, block)."""
    block = F.floor(F.col(offset) / block_size)
    touched = records.select(*keys, block.alias("__block")).where("__block IS NOT NULL").distinct()
    first = F.col("__block") * block_size
    cut = (touched.join(ranges.select(*keys, *RANGE), list(keys))
           .where((F.col("lo") < first + block_size) & (F.col("hi") >= first))
           .select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__block").alias("__at"),
                   F.col("lo").alias("__lo"), F.col("hi").alias("__hi")))
    same = [F.col(k) == F.col(f"__{k}") for k in keys]
    on = (block == F.col("__at")) & (F.col(offset) >= F.col("__lo")) & (F.col(offset) <= F.col("__hi"))
    for s in same:
        on = on & s
    return records.join(cut, on, "left_anti")


def contiguous_commits(ranges: DataFrame, progress: DataFrame | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Commit only the confirmed prefix: the next offset of a log partition is the first
    one that is missing, counted from its first interval or, where ``progress`` (keys,
    committed) has an offset, from the one behind it. Offsets beyond the gap wait.

    Per log partition: first_offset, next_offset, highest_offset, n_intervals, missing
    (offsets not delivered between next_offset and the highest) and whether the commit is
    held back."""
    if progress is None:
        start = ranges.groupBy(*keys).agg(F.min("lo").alias("__start"))
    else:
        start = (ranges.groupBy(*keys).agg(F.min("lo").alias("__least"))
                 .join(progress.select(*keys, "committed"), list(keys), "left")
                 .select(*keys, F.coalesce(F.col("committed") + 1, "__least").alias("__start")))
    r = ranges.select(*keys, *RANGE).join(start, list(keys))
    reached = F.when((F.col("lo") <= F.col("__start")) & (F.col("hi") >= F.col("__start")), F.col("hi") + 1)
    out = r.groupBy(*keys, "__start").agg(
        F.min("lo").alias("first_offset"), F.coalesce(F.max(reached), F.col("__start")).alias("next_offset"),
        F.max("hi").alias("highest_offset"), F.count(F.lit(1)).alias("n_intervals"),
        F.sum(F.greatest(F.col("hi") + 1 - F.greatest("lo", "__start"), F.lit(0))).alias("__held"))
    behind = F.greatest(F.col("highest_offset") + 1 - F.col("__start"), F.lit(0))
    return out.select(*keys, "first_offset", "next_offset", "highest_offset", "n_intervals",
                      (behind - F.col("__held")).alias("missing"),
                      (F.col("next_offset") <= F.col("highest_offset")).alias("held_back"))
