"""Two-level numbering and running totals equal the one-level windows."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.functions.numbering import dense_sequence, first_k_per_group, running_total


def test_dense_sequence_equals_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), i * 3 + rnd.randint(0, 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o long")
    two = dense_sequence(df, ["g"], "o", F.floor(F.col("o") / 97), "n")
    one = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert sorted(map(tuple, two.select("g", "o", "n").collect())) == sorted(map(tuple, one.collect()))


def test_running_total_equals_global_window(spark):
    rnd = random.Random(3)
    rows = [(i, float(rnd.randint(1, 100))) for i in range(2000)]
    df = spark.createDataFrame(rows, "t long, v double")
    two = running_total(df, "t", "v", F.floor(F.col("t") / 50), "s")
    one = df.withColumn("s", F.sum("v").over(Window.orderBy("t")))
    assert sorted(map(tuple, two.select("t", "v", "s").collect())) == sorted(map(tuple, one.collect()))


def test_first_k_per_group(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"))
    got = sorted((r.g, r.o) for r in first_k_per_group(df, ["g"], ["o"], 3, F.col("o") % 7).collect())
    assert got == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3), (1, 5)]


def test_null_keys_and_buckets_stay(spark):
    from pyspark.sql import functions as F

    from sluice.functions.numbering import dense_sequence, running_total
    d = spark.createDataFrame([("a", 1), (None, 2), ("a", 3), (None, 5)], "k string, o long")
    got = dense_sequence(d, ["k"], "o", F.floor(F.col("o") / 2), "n").collect()
    assert sorted((r.k or "", r.o, r.n) for r in got) == [("", 2, 0), ("", 5, 1), ("a", 1, 0), ("a", 3, 1)]
    t = spark.createDataFrame([(1, 5), (None, 7), (3, 2)], "b long, v long")
    got = running_total(t, "b", "v", F.col("b"), "total").collect()
    assert {r.b: r.total for r in got} == {1: 5, 3: 7, None: 14}


def test_null_delivery_keys_are_not_copies(spark):
    from sluice.operators.dedup import keep_first
    d = spark.createDataFrame([(None, 0, 1, "x", 1), (None, 0, 1, "y", 2), ("t", 0, 1, "z", 2), ("t", 0, 1, "z", 1)],
                              "topic string, partition int, offset long, value string, push_time long")
    assert sorted((r.value, r.push_time) for r in keep_first(d).collect()) == [("x", 1), ("y", 2), ("z", 1)]


def test_short_texts_are_masked_whole_and_dots_are_literal(spark):
    from pyspark.sql import functions as F

    from sluice.functions.masking import mask_column
    from sluice.operators.shaping import route_topics
    d = spark.createDataFrame([("1234", "orders.v1"), ("12345", "ordersXv1")], "c string, t string")
    got = d.select(mask_column(F.col("c"), "last4").alias("c"), route_topics(F.col("t"), "orders.v1:T").alias("r")).collect()
    assert [(r.c, r.r) for r in got] == [("****", "T"), ("*2345", "ORDERSXV1")]
