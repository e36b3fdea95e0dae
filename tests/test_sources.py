"""Kafka-shaped decoding (no broker needed) and the live abort rule."""
import datetime as dt
import tempfile


from conftest import log_df
from sluice.operators import landing
from sluice.plans.catalog import USERS
from sluice.sources.log_source import decode_kafka, file_stream
from sluice.streaming import landing as sl
from sluice.streaming.ops import stop_on_abort

KAFKA_SCHEMA = ("key binary, value binary, topic string, partition int, offset long, "
                "timestamp timestamp, timestampType int")


def test_decode_kafka_rows_then_land(spark):
    rows = [(b"7", b'{"USER_ID":1,"City":"X"}', "orders", 0, 5, dt.datetime(2024, 1, 1), 0),
            (None, b"not-json", "orders", 1, 9, dt.datetime(2024, 1, 1), 0)]
    raw = spark.createDataFrame(rows, KAFKA_SCHEMA)
    dec = decode_kafka(raw)
    assert dec.columns == ["topic", "partition", "offset", "key", "value", "timestamp", "push_time"]
    out = landing.parse_or_raw(dec).orderBy("offset").collect()
    assert (out[0].is_object, out[1].raw_data) == (True, "not-json")
    landed = landing.land_by_name(dec, USERS, keep=("offset",)).orderBy("offset").first()
    assert (landed.user_id, landed.city) == (1, "X")


def test_stream_stops_when_errors_grow(spark):
    base = tempfile.mkdtemp(prefix="sluice-abort-", dir="/tmp")
    src = base + "/in"
    batches = [['{"user_id":1}'], ['{"user_id":"x"}'], ['{"user_id":"y"}'], ['{"user_id":2}']]
    off = 0
    for i, vals in enumerate(batches):
        log_df(spark, [("u", 0, off + j, v) for j, v in enumerate(vals)]) \
            .coalesce(1).write.mode("append").parquet(src)
        off += len(vals)
    q, state = sl.start_landing(file_stream(spark, src, max_files_per_trigger=1), USERS,
                                base + "/landed", base + "/errors", checkpoint=base + "/ckpt",
                                trigger={"processingTime": "200 milliseconds"})
    aborted = stop_on_abort(q, state, poll_seconds=0.05, timeout_seconds=90)
    q.awaitTermination(30)
    assert aborted and not q.isActive
    assert state.error_history[:3] == [0, 1, 2][:len(state.error_history[:3])]
