"""Live dashboard queries over the landed table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.numbering import running_total
from sluice.functions.timefn import trunc_ntz


def money(c):
    """Money results leave as double (sums of decimals are exact before)."""
    return c.cast("double")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def totals(df: DataFrame, amount: str = "order_amount") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  money(F.coalesce(F.sum(amount), F.lit(0))).alias("total_revenue"))


def latest(df: DataFrame) -> DataFrame:
    return df.agg(F.max("user_id").alias("latest_id"),
                  F.count_distinct("country").alias("unique_countries"))


def top_by_revenue(df: DataFrame, dim: str = "country", amount: str = "order_amount",
                   n: int = 10) -> DataFrame:
    """Top ``n`` by exact revenue; ties broken by the dimension value."""
    return (df.groupBy(dim).agg(F.sum(amount).alias("revenue"))
            .orderBy(F.desc("revenue"), F.asc(dim)).limit(n)
            .withColumn("revenue", money(F.col("revenue"))))


def run_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  money(F.sum("order_amount")).alias("total_revenue"),
                  F.count_distinct("country").alias("unique_countries"),
                  F.min("registration_date").alias("first_record"),
                  F.max("registration_date").alias("last_record"))


def recent_records(df: DataFrame, n: int = 20) -> DataFrame:
    return (df.select("user_id", "first_name", "last_name", "email", "country",
                      money(F.col("order_amount")).alias("order_amount"))
            .orderBy(F.desc("user_id")).limit(n))


def sample_rows(df: DataFrame, order_by: str, n: int = 10) -> DataFrame:
    """``SELECT * ... LIMIT n``, ordered so the sample is reproducible."""
    return df.orderBy(order_by).limit(n)


def cumulative_revenue(df: DataFrame, ts: str = "registration_date",
                       amount: str = "order_amount") -> DataFrame:
    """``SUM(SUM(amount)) OVER (ORDER BY DATE_TRUNC('second', ts))``.

    Per-second sums are a partial aggregate; the running total is computed in
    two levels (per day, then day offsets) instead of one global window, which
    Spark would run in a single task.
    """
    buckets = (df.groupBy(trunc_ntz("second", F.col(ts)).alias("time_bucket"))
               .agg(F.sum(amount).alias("bucket_revenue")))
    out = running_total(buckets, "time_bucket", "bucket_revenue",
                        F.to_date("time_bucket"), "cumulative_revenue")
    return out.select("time_bucket", money(F.col("cumulative_revenue")).alias("cumulative_revenue"))
