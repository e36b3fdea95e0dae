"""Delivery bookkeeping and de-duplication (the consumer unit-test cases)."""
from pyspark.sql import functions as F

from conftest import log_df
from sluice.operators import dedup, delivery, landing, shaping
from sluice.operators.spec import TableSpec


def test_channel_names(spark):
    df = spark.createDataFrame([(0,), (1,)], "partition int")
    got = [r.c for r in df.select(shaping.channel_name("TEST_CHANNEL", F.col("partition")).alias("c"))
           .orderBy("c").collect()]
    assert got == ["TEST_CHANNEL_P0", "TEST_CHANNEL_P1"]


def test_resume_from_token_or_earliest(spark):
    recs = log_df(spark, [("t", 0, o, "{}") for o in range(40, 46)] + [("t", 1, o, "{}") for o in range(3)])
    prog = spark.createDataFrame([("t", 0, 42), ("t", 1, None)], "topic string, partition int, committed long")
    got = {(r.partition, r.resume_offset, r.pending_rows) for r in delivery.resume_points(recs, prog).collect()}
    assert got == {(0, 43, 3), (1, 0, 3)}


def test_resume_on_fresh_start_keeps_everything(spark):
    recs = log_df(spark, [("t", 0, o, "{}") for o in range(5)])
    prog = spark.createDataFrame([], "topic string, partition int, committed long")
    assert delivery.resume_from_committed(recs, prog).count() == 5


def test_commit_is_token_plus_one(spark):
    recs = log_df(spark, [("t", 0, 5, "{}"), ("t", 1, 10, "{}"), ("t", 1, 7, "{}")])
    got = {(r.partition, r.next_offset) for r in delivery.committed_offsets(recs).collect()}
    assert got == {(0, 6), (1, 11)}


def test_commit_only_when_token_advanced(spark):
    st = spark.createDataFrame(
        [("c", 1, None), ("c", 2, "5"), ("c", 3, "5"), ("c", 4, "6"), ("c", 5, "abc")],
        "channel string, poll_ts int, committed_token string")
    got = [(r.committed_token, r.commit_offset) for r in delivery.advanced_commits(st).orderBy("poll_ts").collect()]
    assert got == [("5", 6), ("6", 7), ("abc", None)]


def test_null_token_does_not_reset_last_commit(spark):
    st = spark.createDataFrame([("c", 1, "5"), ("c", 2, None), ("c", 3, "5"), ("c", 4, "6")],
                               "channel string, poll_ts int, committed_token string")
    got = [r.committed_token for r in delivery.advanced_commits(st).orderBy("poll_ts").collect()]
    assert got == ["5", "6"]


def test_redelivery_keep_first_and_literal_delete(spark):
    df = spark.createDataFrame(
        [("t", 0, 1, 100, "a"), ("t", 0, 1, 200, "b"), ("t", 0, 2, 100, "c")],
        "topic string, partition int, offset long, push_time long, v string")
    kept = {(r.offset, r.v) for r in dedup.keep_first(df).collect()}
    assert kept == {(1, "a"), (2, "c")}
    assert {r.offset for r in dedup.drop_duplicated_keys(df).collect()} == {2}
    g = dedup.duplicate_groups(df).collect()
    assert len(g) == 1 and g[0].copies == 2
    assert dedup.distinct_copy(df, ["topic", "partition", "offset"]).count() == 2


def test_hot_key_collapses_before_shuffle(spark):
    """One key holding most rows: keep-first is a partial aggregate, so the
    plan combines map-side (no window over the hot key)."""
    df = spark.range(20000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                                   (F.col("id") % 3).alias("offset"), F.col("id").alias("push_time"))
    out = dedup.keep_first(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert sorted((r.offset, r.push_time) for r in out.collect()) == [(0, 0), (1, 1), (2, 2)]


def test_error_cap_stops_at_fifth_error(spark):
    spec = TableSpec.from_tuples("t", [("n", "bigint", None)])
    vals = ['{"n":1}' if i % 3 else '{"n":"x"}' for i in range(30)]
    rows = [("t", 0, i, v) for i, v in enumerate(vals)] + [("t", 1, 0, '{"n":"y"}')]
    v = landing.validate(log_df(spark, rows), spec, keep=("topic", "partition", "offset"))
    got = {r.partition: (r.stop_offset, r.rows_sent, r.errors_seen)
           for r in delivery.error_cap(v, 5, block_size=4).collect()}
    assert got == {0: (12, 13, 5), 1: (None, 1, 1)}


def test_commit_wait(spark):
    st = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00", 10, None), ("a", "2024-01-01 01:00:00", 12, "10"),
         ("b", "2024-01-01 00:00:00", 7, "1"), ("b", "2024-01-01 09:00:00", 9, "7")],
        "channel string, poll_ts string, sent_offset long, committed_token string") \
        .withColumn("poll_ts", F.col("poll_ts").cast("timestamp_ntz"))
    got = {r.channel: r.wait_status for r in delivery.commit_wait(
        st, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"), 6).collect()}
    assert got == {"a": "committed", "b": "timed_out"}
