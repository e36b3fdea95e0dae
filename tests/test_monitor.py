"""Monitor cases: lag, abort on error growth, health."""
from pyspark.sql import functions as F

from sluice.operators import monitor


def _status(spark, rows):
    return spark.createDataFrame(
        rows, "channel string, poll_ts string, sent_offset long, committed_token string, "
              "rows_error_count long, status_code string") \
        .withColumn("poll_ts", F.col("poll_ts").cast("timestamp_ntz"))


def test_lag_cases(spark):
    st = _status(spark, [("c", "2024-01-01 00:00:00", 200, "150", 0, "SUCCESS"),
                         ("c", "2024-01-01 00:00:01", 150, None, 0, "SUCCESS"),
                         ("c", "2024-01-01 00:00:02", 210, "abc", 0, "SUCCESS")])
    got = [(r.sent_highest, r.offset_lag) for r in monitor.offset_lag(st).orderBy("poll_ts").collect()]
    assert got == [(200, 50), (200, None), (210, None)]


def test_sent_never_below_zero(spark):
    st = _status(spark, [("c", "2024-01-01 00:00:00", -5, "0", 0, "SUCCESS")])
    assert monitor.offset_lag(st).first().sent_highest == 0


def test_abort_rules(spark):
    st = _status(spark, [("a", "2024-01-01 00:00:00", 10, "5", 3, "SUCCESS"),
                         ("a", "2024-01-01 00:00:01", 20, "5", 3, "SUCCESS"),
                         ("b", "2024-01-01 00:00:00", 10, "5", 0, "SUCCESS"),
                         ("b", "2024-01-01 00:00:01", 200, "5", 1, "SUCCESS"),
                         ("b", "2024-01-01 00:00:02", 300, "5", 2, "SUCCESS")])
    g = {(r.channel, str(r.poll_ts)[-1]): r.abort for r in monitor.error_growth(st).collect()}
    assert g[("a", "0")] is False and g[("a", "1")] is False
    assert g[("b", "0")] is False and g[("b", "1")] is True
    ap = monitor.abort_point(st).collect()
    assert len(ap) == 1 and ap[0].channel == "b" and ap[0].next_unsent_offset == 201


def test_unhealthy_listed_at_each_check(spark):
    st = _status(spark, [("a", "2024-01-01 00:00:00", 1, "1", 0, "SUCCESS"),
                         ("a", "2024-01-01 00:00:30", 1, "1", 0, "ERR_X"),
                         ("a", "2024-01-01 00:01:00", 1, "1", 0, "ERR_X"),
                         ("a", "2024-01-01 00:01:40", 1, "1", 0, "SUCCESS"),
                         ("b", "2024-01-01 00:00:30", 1, "1", 0, "SUCCESS"),
                         ("c", "2024-01-01 00:00:31", 1, "1", 0, "ERR_Y"),
                         ("c", "2024-01-01 00:00:40", 1, "1", 0, "SUCCESS")])
    rows = monitor.unhealthy_channels(st).orderBy("check_period").collect()
    assert [(r.channel, r.last_status, str(r.check_period)[-8:]) for r in rows] == [("a", "ERR_X", "00:00:30"), ("a", "ERR_X", "00:01:00")]
    assert monitor.unhealthy_channels(st, every="1 day").count() == 0  # healed by the end of the day


def test_client_leak_rule(spark):
    st = spark.createDataFrame([("c1", "T"), ("c2", "T")], "client string, target_table string")
    assert monitor.client_leaks(st).first().leak_suspected is True
