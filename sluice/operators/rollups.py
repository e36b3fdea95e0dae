"""Roll-ups of raw records that can be merged: row counts, distinct counts and
percentiles by hour, and from the hours any longer range without reading a record again.

Distinct counts are HyperLogLog sketches, percentiles are KLL sketches; both are partial
aggregates of bounded size, so a hot hour or dimension value is combined map-side and
only sketches are shuffled. A distinct count has a relative standard error of about
``1.04 / sqrt(2 ** lg_k)`` and is exact while the values are few; a percentile's rank
is off by about ``2 / k``. Merged hours have the same bounds as one sketch over all rows.

Defined cases: NULL values are in no sketch (a range with none has count 0 and NULL
percentiles) but their rows count; a NULL time or dimension value is a group of its own;
an empty table gives no groups.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.timefn import trunc_ntz

LG_K = 12
K = 800


def hourly(records: DataFrame, time: Column, distinct: Mapping[str, Column] | None = None,
           measured: Mapping[str, Column] | None = None, by: Sequence[str] = (), lg_k: int = LG_K, k: int = K) -> DataFrame:
    """One row per hour and ``by``: n_rows, a sketch ``<name>_hll`` of each distinct
    column and a sketch ``<name>_kll`` of each measured one."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.hll_sketch_agg(c, lg_k).alias(f"{n}_hll") for n, c in (distinct or {}).items()]
    aggs += [F.kll_sketch_agg_double(c.cast("double"), k).alias(f"{n}_kll") for n, c in (measured or {}).items()]
    return records.groupBy(trunc_ntz("hour", time).alias("hour"), *by).agg(*aggs)


def merged(hours: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Hours put together by any columns or expressions of theirs (such as the day);
    the result can be merged again."""
    aggs = [F.sum("n_rows").alias("n_rows")]
    aggs += [F.hll_union_agg(c).alias(c) for c in hours.columns if c.endswith("_hll")]
    aggs += [F.kll_merge_agg_double(c).alias(c) for c in hours.columns if c.endswith("_kll")]
    return hours.groupBy(*by).agg(*aggs)


def figures(rollup: DataFrame, percentiles: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """The sketches of a roll-up read out: ``unique_<name>`` and ``<name>_p50`` etc."""
    out = []
    for c in rollup.columns:
        if c.endswith("_hll"):
            out.append(F.hll_sketch_estimate(c).alias(f"unique_{c[:-4]}"))
        elif c.endswith("_kll"):
            some = F.kll_sketch_get_n_double(c) > 0
            out += [F.when(some, F.kll_sketch_get_quantile_double(c, F.lit(float(p)))).alias(f"{c[:-4]}_p{100 * p:g}".replace(".", "_"))
                    for p in percentiles]
        else:
            out.append(F.col(c))
    return rollup.select(*out)
