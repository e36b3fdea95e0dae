"""Streaming forms: stream = batch, restart without loss or repeats,
re-delivery, evolution, de-dup within a watermark, progress marks."""
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL, log_df
from sluice.operators import landing
from sluice.plans.catalog import FIXES, USERS
from sluice.sources import fixtures as fx
from sluice.sources.log_source import LOG_SCHEMA, check_converters, file_stream
from sluice.streaming import landing as sl
from sluice.streaming.ops import ProgressMarks, dedup_within_watermark

import pytest


def _dirs():
    base = tempfile.mkdtemp(prefix="sluice-stream-", dir="/tmp")
    return base + "/in", base + "/landed", base + "/errors", base + "/ckpt"


def _run(spark, src, target, errors, ckpt):
    q, state = sl.start_landing(file_stream(spark, src), USERS, target, errors, checkpoint=ckpt,
                                trigger={"availableNow": True}, text_fixes=FIXES)
    q.awaitTermination(120)
    return state


def test_stream_equals_batch_and_restart_is_exactly_once(spark):
    src, target, errors, ckpt = _dirs()
    recs = fx.log_records_bad(spark, SF_SMALL)
    first = recs.where(F.col("offset") % 2 == 0)
    first.repartition(3).write.parquet(src)
    _run(spark, src, target, errors, ckpt)
    # second run: new records plus a re-delivery of some already-landed ones
    more = recs.where(F.col("offset") % 2 == 1).unionByName(first.where(F.col("offset") % 4 == 0))
    more.repartition(2).write.mode("append").parquet(src)
    _run(spark, src, target, errors, ckpt)
    # third run: nothing new -> nothing written twice
    _run(spark, src, target, errors, ckpt)

    landed = sl.read_landed(spark, target)
    assert landed.count() == landed.select("topic", "partition", "offset").distinct().count()
    v = landing.validate(recs, USERS, keep=("topic", "partition", "offset"), text_fixes=FIXES)
    expect_good = v.where("is_valid").count()
    assert landed.count() == expect_good
    errs = spark.read.parquet(errors)
    assert errs.select("topic", "partition", "offset").distinct().count() == v.where("not is_valid").count()
    got = landed.select("topic", "partition", "offset", "user_id", "city").exceptAll(
        v.where("is_valid").select("topic", "partition", "offset", "user_id", "city"))
    assert got.count() == 0


def test_replayed_epoch_overwrites_itself(spark):
    _, target, errors, _ = _dirs()
    df = log_df(spark, [("u", 0, i, '{"user_id":%d}' % i) for i in range(5)])
    sl.land_batch(df, 0, USERS, target, errors)
    sl.land_batch(df, 0, USERS, target, errors)     # the same epoch again
    assert sl.read_landed(spark, target).count() == 5
    sl.land_batch(df, 1, USERS, target, errors)     # a re-delivery in a new epoch
    assert sl.read_landed(spark, target).count() == 5


def test_schema_evolution_adds_columns(spark):
    _, target, errors, _ = _dirs()
    spec = USERS.__class__(USERS.name, USERS.columns, evolve=True)
    sl.land_batch(log_df(spark, [("u", 0, 0, '{"user_id":1}')]), 0, spec, target, errors)
    sl.land_batch(log_df(spark, [("u", 0, 1, '{"user_id":2,"Loyalty_Tier":"gold","visits":3}')]),
                  1, spec, target, errors)
    rows = {r.user_id: r for r in sl.read_landed(spark, target).collect()}
    assert rows[1].loyalty_tier is None and rows[2].loyalty_tier == "gold" and rows[2].visits == 3


def test_evolution_keeps_the_type_of_a_landed_column(spark):
    _, target, errors, _ = _dirs()
    spec = USERS.__class__(USERS.name, USERS.columns, evolve=True)
    sl.land_batch(log_df(spark, [("u", 0, 0, '{"x":5}')]), 0, spec, target, errors)
    sl.land_batch(log_df(spark, [("u", 0, 1, '{"X":"abc"}'), ("u", 0, 2, '{"x":7}')]), 1, spec, target, errors)
    assert {r.offset: r.x for r in sl.read_landed(spark, target).collect()} == {0: 5, 2: 7}
    bad = spark.read.parquet(errors).collect()
    assert [(r.offset, r.value, r.error_reasons) for r in bad] == [(1, '{"X":"abc"}', "x:invalid_bigint")]


def test_evolution_folds_keys_that_differ_by_case(spark):
    _, target, errors, _ = _dirs()
    spec = USERS.__class__(USERS.name, USERS.columns, evolve=True)
    sl.land_batch(log_df(spark, [("u", 0, 0, '{"Foo":5}'), ("u", 0, 1, '{"foo":"abc"}')]), 0, spec, target, errors)
    assert {r.offset: r.foo for r in sl.read_landed(spark, target).collect()} == {0: "5", 1: "abc"}


def test_error_rows_keep_the_record(spark):
    _, target, errors, _ = _dirs()
    sl.land_batch(log_df(spark, [("u", 4, 0, '{"user_id":"x","date_of_birth":"y"}')]), 0, USERS, target, errors)
    r = spark.read.parquet(errors).first()
    assert (r.key, r.value, r.n_reasons) == ("4", '{"user_id":"x","date_of_birth":"y"}', 2)


def test_abort_counts_survive_restart_and_replay(spark):
    _, target, errors, _ = _dirs()
    bad = log_df(spark, [("u", 0, 0, '{"user_id":"x"}')])
    st = sl.LandingState()
    sl.land_batch(bad, 0, USERS, target, errors, st)
    sl.land_batch(bad, 0, USERS, target, errors, st)       # a replay of the same epoch
    assert st.rows_error == 1 and not st.abort
    st = sl.LandingState()                                 # a new driver
    sl.land_batch(log_df(spark, [("u", 0, 1, '{"user_id":"y"}')]), 1, USERS, target, errors, st)
    assert st.rows_error == 2 and st.abort


def test_abort_when_errors_grow(spark):
    _, target, errors, _ = _dirs()
    st = sl.LandingState()
    sl.land_batch(log_df(spark, [("u", 0, 0, '{"user_id":"x"}')]), 0, USERS, target, errors, st)
    assert not st.abort                                    # first poll never aborts
    sl.land_batch(log_df(spark, [("u", 0, 1, '{"user_id":1}')]), 1, USERS, target, errors, st)
    assert not st.abort                                    # steady
    sl.land_batch(log_df(spark, [("u", 0, 2, '{"user_id":"y"}')]), 2, USERS, target, errors, st)
    assert st.abort


def test_dedup_within_watermark(spark):
    src, *_ = _dirs()
    rows = [("t", 0, i % 5, "k", "{}", None, 0) for i in range(10)]
    df = spark.createDataFrame(rows, LOG_SCHEMA).withColumn(
        "timestamp", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    df.write.parquet(src)
    out = dedup_within_watermark(file_stream(spark, src))
    q = (out.writeStream.format("memory").queryName("dedup_wm").trigger(availableNow=True).start())
    q.awaitTermination(60)
    assert spark.table("dedup_wm").count() == 5


def test_progress_marks(spark):
    src, *_ = _dirs()
    log_df(spark, [("t", 0, i, "{}") for i in range(250)]).repartition(5).write.parquet(src)
    marks = []
    listener = ProgressMarks(100, marks.append)
    spark.streams.addListener(listener)
    try:
        q = (file_stream(spark, src).writeStream.format("noop").trigger(availableNow=True).start())
        q.awaitTermination(60)
        import time
        for _ in range(50):
            if len(marks) >= 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert marks == [100, 200]


def test_converter_rules():
    check_converters("string", "json")
    with pytest.raises(ValueError):
        check_converters("string", "string", schematized=True)
    check_converters("string", "string", schematized=False)
