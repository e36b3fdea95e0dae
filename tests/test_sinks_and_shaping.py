"""Sinks (auto-create, must-exist targets, fan-out, fresh checkpoints),
record metadata switches, session context, dedup null guard, inference modes."""
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import log_df
from sluice.operators import dedup, evolve, shaping
from sluice.sources.log_source import LOG_SCHEMA, file_stream
from sluice.streaming import landing as sl
from sluice.streaming.ops import fan_out, windowed_throughput


def test_append_table_creates_then_appends(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sl.append_table(df, "auto_created")
    sl.append_table(df, "auto_created")
    assert spark.table("auto_created").count() == 2


def test_existing_table_required(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError):
        sl.append_existing_table(df, "no_such_table")
    spark.sql("CREATE TABLE locked (id int, v string) USING parquet")
    with pytest.raises(ValueError):
        sl.append_existing_table(df.withColumn("extra", F.lit(1)), "locked")


def test_fresh_checkpoint_is_new_each_time(spark):
    assert sl.fresh_checkpoint(spark, "ch") != sl.fresh_checkpoint(spark, "ch")


def test_fan_out_one_partitioned_write(spark):
    base = tempfile.mkdtemp(prefix="sluice-fan-", dir="/tmp") + "/out"
    df = log_df(spark, [("orders", 0, 0, "{}"), ("click_events", 0, 1, "{}"), ("misc-x", 0, 2, "{}")])
    fan_out(df, "orders:ORDER_TABLE,.*_events:ALL_EVENTS", base)
    got = {r.target_table: r.n for r in spark.read.parquet(base).groupBy("target_table")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"ORDER_TABLE": 1, "ALL_EVENTS": 1, "MISC_X": 1}
    fan_out(df, "orders:ORDER_TABLE,.*_events:ALL_EVENTS", base)          # a replayed epoch
    assert spark.read.parquet(base).count() == 3
    fan_out(df, "orders:ORDER_TABLE,.*_events:ALL_EVENTS", base, epoch=1)
    assert spark.read.parquet(base).count() == 6


def test_metadata_switches(spark):
    df = log_df(spark, [("t", 3, 7, "{}")])
    full = shaping.with_record_metadata(df).select("record_metadata.*")
    assert full.columns == ["topic", "partition", "offset", "CreateTime", "ConnectorPushTime", "key"]
    assert full.first().partition == "3"
    no_topic = shaping.with_record_metadata(df, topic=False).select("record_metadata.*")
    assert "topic" not in no_topic.columns
    no_op = shaping.with_record_metadata(df, offset_and_partition=False).select("record_metadata.*")
    assert "offset" not in no_op.columns and "partition" not in no_op.columns
    assert "record_metadata" not in shaping.with_record_metadata(df, all_fields=False).columns
    two = shaping.two_variant_layout(df)
    assert two.columns == ["record_content", "record_metadata"]


def test_session_context(spark):
    r = shaping.session_context(spark).first()
    assert r.current_catalog == "spark_catalog" and r.current_database == "default"


def test_literal_delete_keeps_null_keys(spark):
    df = spark.createDataFrame([("t", 0, None, 1), ("t", 0, None, 2), ("t", 0, 1, 3), ("t", 0, 1, 4)],
                               "topic string, partition int, offset long, push_time long")
    got = sorted(r.push_time for r in dedup.drop_duplicated_keys(df).collect())
    assert got == [1, 2]


def test_inference_modes(spark):
    df = log_df(spark, [("t", 0, 0, '{"d":"2026-04-13","n":1,"x":1.5,"b":true,"o":{"a":1},"s":"hi"}'),
                        ("t", 0, 1, '{"d":"2026-04-14","n":2,"x":2,"b":false,"o":{"a":2},"s":"3"}')])
    server = {r.key: r.inferred_type for r in evolve.infer_key_types(df).collect()}
    assert server == {"d": "DATE", "n": "BIGINT", "x": "DECIMAL", "b": "BOOLEAN", "o": "OBJECT", "s": "VARCHAR"}
    client = {r.key: r.inferred_type for r in evolve.infer_key_types(df, dates_as_text=True).collect()}
    assert client["d"] == "VARCHAR"


def test_windowed_throughput_stream(spark):
    src = tempfile.mkdtemp(prefix="sluice-tp-", dir="/tmp") + "/in"
    rows = [("t", 0, i, "k", "{}", None, 0) for i in range(120)]
    df = spark.createDataFrame(rows, LOG_SCHEMA).withColumn(
        "timestamp", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,offset)"))
    df.write.parquet(src)
    q = (windowed_throughput(file_stream(spark, src)).writeStream.format("memory")
         .queryName("tp").outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination(60)
    got = sorted((r.n_records, r.records_per_sec) for r in spark.table("tp").collect())
    assert got == [(60, 1.0), (60, 1.0)]
