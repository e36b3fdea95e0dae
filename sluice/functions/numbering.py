"""Sequence numbers and running totals without single-task windows.

``row_number() OVER (PARTITION BY p ORDER BY o)`` puts all rows of one ``p`` in
one task, and ``SUM(..) OVER (ORDER BY o)`` with no partition puts *all* rows
in one task. At scale a single log partition (or the whole table) is far too
big for that, so both are computed in two levels:

1. cut the order key into blocks (a monotone function of the order key), and
   count / sum per (p, block) -- a partial aggregate, combined map-side;
2. an exclusive prefix over the block table, which has one row per block and is
   small compared with the data;
3. a window per (p, block) -- many small, evenly spread windows -- plus the
   block's base from step 2.

The result equals the one-level window exactly.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.plan import fence

_BLOCK = "__blk"
_BASE = "__base"


def _with_base(d: DataFrame, bases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach each block's base; NULL keys and blocks meet their own base."""
    b = bases.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)], _BASE)
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__b{i}"))
        cond = c if cond is None else cond & c
    return d.join(b, cond, "inner").drop(*[f"__b{i}" for i in range(len(keys))])


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def dense_sequence(df: DataFrame, partition_by: Sequence[str], order_by: str,
                   block: Column, name: str, start: int = 0) -> DataFrame:
    """Add ``name`` = ``row_number() - 1 + start`` over (partition_by, order_by).

    ``block`` must be non-decreasing in ``order_by`` within a partition (for
    example ``floor(event_id / 65536)``) and ``order_by`` must be unique within
    a partition.
    """
    keys = list(partition_by)
    d = df.withColumn(_BLOCK, block)
    counts = d.groupBy(*keys, _BLOCK).agg(F.count(F.lit(1)).alias("__n"))
    w_blocks = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(
        Window.unboundedPreceding, -1)
    bases = counts.select(*keys, _BLOCK,
                          F.coalesce(F.sum("__n").over(w_blocks), F.lit(0)).alias(_BASE))
    w_rows = Window.partitionBy(*keys, _BLOCK).orderBy(order_by)
    out = (_with_base(d, bases, [*keys, _BLOCK])
           .withColumn(name, F.row_number().over(w_rows) - 1 + F.col(_BASE) + F.lit(start))
           .drop(_BLOCK, _BASE))
    return out


def running_total(df: DataFrame, order_by: str, value: str, block: Column,
                  name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Add ``name`` = ``SUM(value) OVER (PARTITION BY partition_by ORDER BY
    order_by)`` (RANGE frame: rows with equal ``order_by`` share the total).

    ``df`` is expected to be pre-aggregated so that ``order_by`` is unique per
    partition (as in a series of time buckets); ``block`` must be monotone in
    ``order_by``. A NULL bucket comes last.
    """
    keys = list(partition_by)
    # One hash exchange by (keys, block) feeds both the block totals and the
    # per-block windows, so the (often expensive) input is computed once and
    # neither step shuffles again.
    d = fence(df.withColumn(_BLOCK, block).repartition(*keys, _BLOCK))
    totals = d.groupBy(*keys, _BLOCK).agg(F.sum(value).alias("__s"))
    w_blocks = Window.partitionBy(*keys).orderBy(F.col(_BLOCK).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    bases = totals.select(*keys, _BLOCK, F.sum("__s").over(w_blocks).alias(_BASE))
    w_rows = (Window.partitionBy(*keys, _BLOCK).orderBy(order_by)
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    within = F.sum(value).over(w_rows)
    out = (_with_base(d, bases, [*keys, _BLOCK])
           .withColumn(name, F.when(F.col(_BASE).isNull(), within)
                       .otherwise(within + F.col(_BASE)))
           .drop(_BLOCK, _BASE))
    return out


def first_k_per_group(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str],
                      k: int, spread: Column) -> DataFrame:
    """The first ``k`` rows of each group in ``order_by`` order, exact.

    A hot group is first cut by ``spread`` (any column that splits it, such as a
    block of the order key or a hash); each piece keeps its own first ``k``, so
    at most ``k`` rows per piece reach the final per-group window.
    """
    keys = list(group_by)
    order = _as_cols(order_by)
    pre = (df.withColumn("__spread", spread)
           .withColumn("__r1", F.row_number().over(
               Window.partitionBy(*keys, "__spread").orderBy(*order)))
           .where(F.col("__r1") <= k)
           .drop("__r1", "__spread"))
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (pre.withColumn("__rank", F.row_number().over(w2))
            .where(F.col("__rank") <= k))
