"""Waiting until a running stream has committed what the caller needs.

The wait is woken by the query's progress events and asks the committed state itself
(the interval sets of landed offsets), so it also holds over a restart: what an earlier
run has committed is seen at once.
"""
from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from sluice.operators.intervals import contiguous_commits
from sluice.streaming.intervals import IntervalStore

COMMITTED, TIMED_OUT, STOPPED = "committed", "timed_out", "stopped"


class _Wake(StreamingQueryListener):
    """Sets an event at each progress or end of a query."""

    def __init__(self):
        self.event = threading.Event()

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.event.set()

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.event.set()


def wait_until(spark: SparkSession, query: StreamingQuery, reached: Callable[[], bool], timeout_seconds: float) -> str:
    """``committed`` as soon as ``reached()`` holds, ``stopped`` when the query ended
    without it (a query that failed raises its error), else ``timed_out``. ``reached`` is
    asked at once, after each progress event, and a last time at the deadline."""
    wake, deadline = _Wake(), time.monotonic() + timeout_seconds
    spark.streams.addListener(wake)
    try:
        while True:
            wake.event.clear()
            active = query.isActive  # before the question: what was committed last is seen
            if reached():
                return COMMITTED
            if not active:
                if query.exception() is not None:
                    raise query.exception()
                return STOPPED
            left = deadline - time.monotonic()
            if left <= 0:
                return TIMED_OUT
            wake.event.wait(min(left, 1.0))  # a lost event costs a second
    finally:
        spark.streams.removeListener(wake)


def offsets_committed(store: IntervalStore, wanted: Mapping[tuple[str, int], int]) -> Callable[[], bool]:
    """Whether every wanted offset of a (topic, partition) is inside the confirmed
    prefix: offsets behind a gap are not committed."""
    def reached() -> bool:
        if not wanted:
            return True
        epochs = store.epochs()
        seen = store.before(epochs[-1] + 1) if epochs else None
        if seen is None:
            return False
        done = {(r.topic, r.partition): r.next_offset for r in contiguous_commits(seen).collect()}  # one row per log partition
        return all(done.get(key, -1) > offset for key, offset in wanted.items())

    return reached


def wait_for_offsets(spark: SparkSession, query: StreamingQuery, target: str, wanted: Mapping[tuple[str, int], int],
                     timeout_seconds: float) -> str:
    """Wait until a landing query has committed the given offsets of its log partitions."""
    return wait_until(spark, query, offsets_committed(IntervalStore(spark, target.rstrip("/") + "-intervals"), wanted), timeout_seconds)
