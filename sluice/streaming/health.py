"""Timed health checks of channels on a running stream of polls.

Each channel has one row of state and one processing-time timer, set to the next multiple
of the interval. A check therefore happens also when no new poll arrives. State is one row
a channel, so it grows with channels, never with polls, and a channel silent for
``forget`` seconds is reported once more as ``gone`` and its state removed.

At a check a channel is reported with one reason:

* ``status``: its newest poll is not SUCCESS (an unknown status counts as a fault);
* ``silent``: no poll arrived since the last check, whatever its last status was;
* ``healed``: its newest poll is SUCCESS, but a poll since the last check was a fault;
* ``gone``: as above.

Defined cases: among polls of one time the fault wins; a poll older than the newest one
counts as a fault poll but does not change the status; polls without a channel form one
channel (NULL), polls without a time are older than all others. When batches take longer
than an interval, the checks in between are one check at the first one's time.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
REPORT = "channel string, check_ts timestamp, reason string, last_status string, last_poll_ts timestamp, n_polls long, n_faults long"
STATE = "last_us long, status string, n_polls long, n_faults long, heard_ms long"
OLDEST = -(1 << 62)


class HealthCheck(StatefulProcessor):
    def __init__(self, interval_ms: int, forget_ms: int):
        self.interval, self.forget = interval_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("channel", STATE)

    def _next(self, now: int) -> int:
        return (now // self.interval + 1) * self.interval

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = timerValues.getCurrentProcessingTimeInMs()
        known = self.state.get() if self.state.exists() else None
        last, status, n, faults, _ = known or (OLDEST, None, 0, 0, now)
        for polls in rows:
            ok = polls["status_code"].eq("SUCCESS").fillna(False).astype(bool)
            n, faults = n + len(polls), faults + int((~ok).sum())
            newest = int(polls["at_us"].max())
            if newest >= last:
                at = polls["at_us"] == newest
                bad = polls[at & ~ok]["status_code"]
                if newest > last or len(bad):
                    status = "SUCCESS" if not len(bad) else min((s for s in bad if isinstance(s, str)), default=None)
                last = newest
        self.state.update((last, status, n, faults, now))
        if known is None:
            self.handle.registerTimer(self._next(now))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        now, due = timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()
        last, status, n, faults, heard = self.state.get()
        gone = n == 0 and now - heard >= self.forget
        reason = "gone" if gone else "silent" if n == 0 else "status" if status != "SUCCESS" else "healed" if faults else None
        if gone:
            self.state.clear()
        else:
            self.state.update((last, status, 0, 0, heard))
            self.handle.registerTimer(self._next(now))
        if reason:
            yield pd.DataFrame({"channel": [key[0]], "check_ts": [pd.Timestamp(due, unit="ms")], "reason": [reason],
                                "last_status": [status], "last_poll_ts": [pd.Timestamp(last, unit="us") if last != OLDEST else pd.NaT],
                                "n_polls": [n], "n_faults": [faults]})

    def close(self) -> None:
        pass


def health_checks(polls: DataFrame, every: int = 30, forget: int = 86_400) -> DataFrame:
    """The reports of a stream of polls (``channel``, ``poll_ts``, ``status_code``), a check
    each ``every`` seconds. The query needs the RocksDB state store (see
    :func:`start_health_checks`) and a processing-time trigger."""
    at = F.coalesce(F.unix_micros(F.col("poll_ts").cast("timestamp")), F.lit(OLDEST))
    return (polls.select(F.col("channel").cast("string").alias("channel"), "status_code", at.alias("at_us"))
            .groupBy("channel")
            .transformWithStateInPandas(statefulProcessor=HealthCheck(every * 1000, forget * 1000), outputStructType=REPORT,
                                        outputMode="Append", timeMode="ProcessingTime"))


def start_health_checks(polls: DataFrame, target: str, checkpoint: str, every: int = 30, forget: int = 86_400,
                        trigger: dict | None = None):
    """Append the reports to ``target`` (Parquet). The state store is set for this query's
    start only; the session's setting is put back."""
    conf = polls.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)
    try:
        return (health_checks(polls, every, forget).writeStream.format("parquet").outputMode("append")
                .option("path", target).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": f"{max(1, every // 3)} seconds"})).start())
    finally:
        if before is None:
            conf.unset(PROVIDER)
        else:
            conf.set(PROVIDER, before)
