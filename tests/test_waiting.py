"""Waiting for commits of a running landing query."""
import tempfile

from conftest import log_df
from sluice.plans.catalog import USERS
from sluice.sources.log_source import file_stream
from sluice.streaming import landing as sl
from sluice.streaming.waiting import COMMITTED, STOPPED, TIMED_OUT, wait_for_offsets, wait_until


def _start(spark, base, **trigger):
    return sl.start_landing(file_stream(spark, base + "/in"), USERS, base + "/t", base + "/e", checkpoint=base + "/c",
                            trigger=trigger or {"processingTime": "1 second"})[0]


def test_both_outcomes_and_a_restart(spark):
    base = tempfile.mkdtemp(prefix="sluice-wait-", dir="/tmp")
    add = lambda offsets: log_df(spark, [("u", 0, o, '{"user_id":1}') for o in offsets]).write.mode("append").parquet(base + "/in")
    add([0, 1, 2, 5])                                       # 3 and 4 are missing
    q = _start(spark, base)
    try:
        assert wait_for_offsets(spark, q, base + "/t", {("u", 0): 2}, 60) == COMMITTED
        assert wait_for_offsets(spark, q, base + "/t", {("u", 0): 5}, 2) == TIMED_OUT     # behind the gap
        assert wait_for_offsets(spark, q, base + "/t", {("u", 1): 0}, 1) == TIMED_OUT     # nothing of it yet
        assert wait_for_offsets(spark, q, base + "/t", {}, 0) == COMMITTED
    finally:
        q.stop()
    assert wait_for_offsets(spark, q, base + "/t", {("u", 0): 5}, 60) == STOPPED
    add([3, 4])
    q = _start(spark, base)
    try:
        assert wait_for_offsets(spark, q, base + "/t", {("u", 0): 2}, 0) == COMMITTED     # from the run before
        assert wait_for_offsets(spark, q, base + "/t", {("u", 0): 5}, 60) == COMMITTED
    finally:
        q.stop()


def test_listeners_are_removed(spark):
    base = tempfile.mkdtemp(prefix="sluice-wait-", dir="/tmp")
    log_df(spark, [("u", 0, 0, '{"user_id":1}')]).write.parquet(base + "/in")
    q = _start(spark, base, availableNow=True)
    assert wait_until(spark, q, lambda: not q.isActive, 60) == COMMITTED
    assert wait_until(spark, q, lambda: False, 60) == STOPPED
