"""Timed health checks on a stream of polls."""
import tempfile
import time

from sluice.streaming.health import PROVIDER, start_health_checks

SCHEMA = "channel string, poll_ts timestamp_ntz, status_code string"


def _add(spark, path, *rows):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    data = [(c, None if s is None else base + dt.timedelta(seconds=s), code) for c, s, code in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _wait(spark, path, cond, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        try:
            rows = spark.read.parquet(path).collect()
        except Exception:
            rows = []
        if cond(rows):
            return rows
        time.sleep(0.5)
    raise AssertionError(f"not seen in {seconds} s: {rows}")


def test_faults_healed_silent_and_gone_channels_over_a_restart(spark):
    base = tempfile.mkdtemp(prefix="sluice-health-", dir="/tmp")
    polls, out, cp = base + "/in", base + "/out", base + "/c"
    before = spark.conf.get(PROVIDER, None)
    _add(spark, polls, ("bad", 1, "ERROR"), ("fine", 1, "SUCCESS"), ("healed", 1, "ERROR"), ("healed", 2, "SUCCESS"),
         ("late", 5, "SUCCESS"), ("late", 4, "ERROR"), ("tie", 3, "SUCCESS"), ("tie", 3, "ERROR"), ("unknown", 1, None),
         (None, None, "ERROR"))

    def start():
        return start_health_checks(spark.readStream.schema(SCHEMA).parquet(polls), out, cp, every=2, forget=600,
                                   trigger={"processingTime": "500 milliseconds"})

    q = start()
    try:
        rows = _wait(spark, out, lambda rs: {r.channel for r in rs if r.reason == "silent"} >= {"bad", "fine", "healed", "late", "tie"})
        first = {}
        for r in sorted(rows, key=lambda r: r.check_ts):
            first.setdefault(r.channel, (r.reason, r.last_status, r.n_polls, r.n_faults))
        assert first == {"bad": ("status", "ERROR", 1, 1), "fine": ("silent", "SUCCESS", 0, 0), "healed": ("healed", "SUCCESS", 2, 1),
                         "late": ("healed", "SUCCESS", 2, 1), "tie": ("status", "ERROR", 2, 1), "unknown": ("status", None, 1, 1),
                         None: ("status", "ERROR", 1, 1)}
        assert all(r.check_ts.timestamp() % 2 == 0 for r in rows)
    finally:
        q.stop()
    assert spark.conf.get(PROVIDER, None) == before
    _add(spark, polls, ("bad", 9, "SUCCESS"), ("fine", 9, "DOWN"))
    q = start()                                             # state and timers are kept
    try:
        rows = _wait(spark, out, lambda rs: any(r.channel == "fine" and r.last_status == "DOWN" and r.reason == "silent" for r in rs))
        assert any(r.channel == "fine" and r.reason == "status" and r.n_faults == 1 for r in rows)
        assert any(r.channel == "bad" and r.reason == "silent" and r.last_status == "SUCCESS" for r in rows)
    finally:
        q.stop()


def test_silent_channels_are_forgotten(spark):
    base = tempfile.mkdtemp(prefix="sluice-health-", dir="/tmp")
    _add(spark, base + "/in", ("a", 1, "SUCCESS"))
    q = start_health_checks(spark.readStream.schema(SCHEMA).parquet(base + "/in"), base + "/out", base + "/c", every=1, forget=3,
                            trigger={"processingTime": "300 milliseconds"})
    try:
        _wait(spark, base + "/out", lambda rs: any(r.reason == "gone" for r in rs))
        time.sleep(4)
        rows = sorted(spark.read.parquet(base + "/out").collect(), key=lambda r: r.check_ts)
        assert [r.reason for r in rows].count("gone") == 1 and rows[-1].reason == "gone"
    finally:
        q.stop()
