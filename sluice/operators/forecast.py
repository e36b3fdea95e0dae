"""Daily per-entity features and a short-range forecast.

The model is a per-entity linear trend fitted with SQL regression aggregates
(``regr_slope`` / ``regr_intercept``): a partial aggregate per entity, then a
7-row horizon per entity. No Python in the data path.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.timefn import lit_date

TARGETS = ("drop_rate", "call_volume", "data_usage_mb")


def fit_trends(daily: DataFrame, entity: str = "tower", day: str = "day",
               origin: str = "2024-01-01") -> DataFrame:
    x = F.datediff(F.col(day), lit_date(origin)).cast("double")
    aggs = [F.max(x).alias("last_index"), F.max(day).alias("last_day")]
    for t in TARGETS:
        y = F.col(t).cast("double")
        aggs += [F.regr_slope(y, x).alias(f"{t}_slope"), F.regr_intercept(y, x).alias(f"{t}_icpt")]
    return daily.groupBy(entity).agg(*aggs)


def forecast(daily: DataFrame, horizon: int = 7, entity: str = "tower",
             day: str = "day") -> DataFrame:
    fits = fit_trends(daily, entity, day)
    h = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    d = fits.select("*", h)
    xi = F.col("last_index") + F.col("h")

    def pred(t):
        return F.col(f"{t}_icpt") + F.col(f"{t}_slope") * xi

    return d.select(entity, "h",
                    F.date_add(F.col("last_day"), F.col("h")).alias("forecast_day"),
                    F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), pred("drop_rate"))), 6)
                     .alias("drop_rate_fc"),
                    F.round(F.greatest(F.lit(0.0), pred("call_volume")), 6).alias("call_volume_fc"),
                    F.round(F.greatest(F.lit(0.0), pred("data_usage_mb")), 6).alias("data_usage_fc"))


def critical(fc: DataFrame, threshold: float, entity: str = "tower") -> DataFrame:
    """Rank entities by forecast drop rate; flag those above ``threshold``."""
    return (fc.groupBy(entity)
            .agg(F.round(F.avg("drop_rate_fc"), 6).alias("avg_drop_rate_fc"),
                 F.round(F.sum("data_usage_fc"), 4).alias("total_usage_fc"))
            .withColumn("critical", F.col("avg_drop_rate_fc") > F.lit(threshold)))
