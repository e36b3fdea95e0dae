"""A hot key (one log partition with most of the rows) must not land whole in
one window task: windows over raw rows are keyed by (partition, block)."""
from pyspark.sql import functions as F

from sluice.functions.numbering import dense_sequence
from sluice.operators import dedup, delivery, landing
from sluice.operators.spec import TableSpec


def _skewed(spark, n=30000):
    # partition 0 holds two thirds of the rows
    return spark.range(n).select(
        F.lit("t").alias("topic"),
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7 + 1).cast("int").alias("partition"),
        F.col("id").alias("offset"), F.lit(None).cast("string").alias("key"),
        F.when(F.col("id") % 97 == 0, F.lit('{"n":"x"}')).otherwise(F.lit('{"n":1}')).alias("value"),
        F.col("id").alias("push_time"))


def test_offset_numbering_windows_are_blocked(spark):
    df = _skewed(spark).drop("offset").withColumn("eid", F.col("push_time"))
    out = dense_sequence(df, ["topic", "partition"], "eid", F.floor(F.col("eid") / 1024), "offset")
    plan = out._jdf.queryExecution().executedPlan().toString()
    row_windows = [l for l in plan.split("\n") if "row_number()" in l]
    assert row_windows and all("__blk" in l for l in row_windows)
    assert out.where("partition = 0").agg(F.max("offset")).first()[0] == 19999


def test_error_cap_on_hot_partition(spark):
    spec = TableSpec.from_tuples("t", [("n", "bigint", None)])
    v = landing.validate(_skewed(spark), spec, keep=("topic", "partition", "offset"))
    out = delivery.error_cap(v, 5, block_size=1024)
    plan = out._jdf.queryExecution().executedPlan().toString()
    raw_windows = [l for l in plan.split("\n") if "row_number()" in l]
    assert raw_windows and all("__blk" in l for l in raw_windows)
    r = {x.partition: x for x in out.collect()}
    # errors in partition 0 are ids divisible by 97 with id % 3 < 2
    errs = [i for i in range(30000) if i % 97 == 0 and i % 3 < 2][:5]
    assert r[0].stop_offset == errs[-1]


def test_dedup_of_a_hot_copy_group_combines_map_side(spark):
    df = spark.range(30000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                                   F.lit(7).cast("long").alias("offset"), F.col("id").alias("push_time"))
    out = dedup.keep_first(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan
    assert out.collect()[0].push_time == 0
