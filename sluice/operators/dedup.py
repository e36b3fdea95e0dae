"""De-duplication on the delivery key (topic, partition, offset).

All forms are aggregates with a map-side partial step, so a key that is
copied many times is collapsed before the shuffle and never lands whole in
one task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("topic", "partition", "offset")


def _single(keys: Sequence[str]) -> Column:
    """A grouping key of its own for each row with a NULL in its key."""
    has_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    return F.when(has_null, F.monotonically_increasing_id())


def keep_first(df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ("push_time",)) -> DataFrame:
    """Keep one row per key: the first by ``order`` (ties broken by the other
    columns, so the pick is deterministic). A row with a NULL in its key has no
    identity to repeat, so each such row is kept."""
    rest = [c for c in df.columns if c not in keys]
    tie = [c for c in rest if c not in order]
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(c) for c in (*order, *tie)])
    return (df.groupBy(*keys, _single(keys).alias("__single")).agg(F.min_by(row, rank).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]))


def drop_duplicated_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The literal post-migration DELETE: every row of a key that occurs more
    than once is removed, originals included. Offered for parity; it loses
    data, so :func:`keep_first` is the default.

    Rows with a NULL in the key never match the tuple ``IN`` of the
    reference statement (it is null-unsafe and guarded by ``IS NOT NULL``),
    so they are kept as they are.
    """
    rest = [c for c in df.columns if c not in keys]
    # one pass: a row with a NULL key is a group of one and survives
    return (df.groupBy(*keys, _single(keys).alias("__single"))
            .agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*rest)).alias("__row"))
            .where(F.col("__n") == 1)
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]))


def duplicate_groups(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = "push_time") -> DataFrame:
    """Keys delivered more than once, with the number of copies."""
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("copies"),
                 F.min(ts).alias("first_push_time"), F.max(ts).alias("last_push_time"))
            .where(F.col("copies") > 1))


def distinct_copy(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``INSERT INTO t2 SELECT DISTINCT ...``."""
    return (df.select(*columns) if columns else df).distinct()
