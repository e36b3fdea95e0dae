"""Connected components of a link table by alternating star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return e.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                        F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")) \
        .select("x.*").filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links``: columns a, b. One row (id, component) for every linked id that is
    not the smallest of its component. Each round halves the depth of the trees at
    least; the rounds end when no link changes."""
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e, was = written(e, "links"), None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == was or not mark[0]:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
        was = mark
        e = written(_small_star(_large_star(e)), "links")
