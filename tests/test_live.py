"""Live figures: stream state = batch result after restarts, replays and late rows."""
import datetime as dt
import random
import tempfile
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.functions.timefn import trunc_ntz
from sluice.streaming.live import BlockedSums, TopRows, newest_rows, revenue_by, running_revenue

SCHEMA = ("user_id bigint, first_name string, last_name string, email string, country string, "
          "order_amount decimal(10,2), registration_date timestamp_ntz")


def _folder():
    return tempfile.mkdtemp(prefix="sluice-live-", dir="/tmp")


def _rows(seed, n, days=4):
    r = random.Random(seed)
    out = []
    for k in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=r.randrange(days), seconds=r.randrange(5), milliseconds=r.randrange(1000))
        out.append((r.randrange(200), f"f{k}", "l", "e", r.choice(["US", "DE", "FR", None]),
                    r.choice([None, Decimal(r.randrange(10_000)) / 100]), r.choice([at] * 9 + [None])))
    return out


def _running(rows):
    per = defaultdict(lambda: None)
    for x in rows:
        key = x[6].replace(microsecond=0) if x[6] else None
        per[key] = per[key] if x[5] is None else (per[key] or 0) + x[5]
    total, out = None, {}
    for key in sorted(per, key=lambda k: (k is None, k or 0)):
        total = total if per[key] is None else (total or 0) + per[key]
        out[key] = total
    return out


def test_running_total_with_late_rows_replay_and_restart(spark):
    path = _folder()
    batches = [_rows(1, 60), [], _rows(2, 40, days=1), _rows(3, 60, days=6)]  # the third is late
    done = []
    for epoch, rows in enumerate(batches):
        done += rows
        for _ in range(2):  # the same epoch again, by a new object as after a restart
            running_revenue(spark, path).update(spark.createDataFrame(rows, SCHEMA), epoch)
        got = {r.key: r.cumulative for r in running_revenue(spark, path).running().collect()}
        assert got == _running(done), epoch


def test_late_rows_rewrite_only_their_blocks(spark):
    path = _folder()
    at = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    state = running_revenue(spark, path)
    state.update(spark.createDataFrame([(1, "", "", "", "", Decimal(5), t) for t in at], SCHEMA), 0)
    state.update(spark.createDataFrame([(1, "", "", "", "", Decimal(2), at[1])], SCHEMA), 1)
    assert state.rows.at(1).count() == 1
    assert {r.block.day: r.version for r in state.index.last().collect()} == {1: 0, 2: 1, 3: 0}
    assert [r.cumulative for r in state.running().orderBy("key").collect()] == [5, 12, 17]


def test_old_state_is_removed(spark):
    path = _folder()
    state = running_revenue(spark, path)
    for epoch in range(6):
        state.update(spark.createDataFrame([(1, "", "", "", "", Decimal(1), dt.datetime(2024, 1, 1))], SCHEMA), epoch)
    assert state.index.epochs() == [4, 5] and state.rows.epochs() == [4, 5]
    assert state.running().first().cumulative == 6


def test_top_sums_equal_brute_force(spark):
    path, done = _folder(), []
    for epoch in range(3):
        rows = [(x[0], x[1], x[2], x[3], None if k % 50 == 0 else f"c{x[0] % 37}", x[5], x[6]) for k, x in enumerate(_rows(epoch, 300))]
        done += rows
        revenue_by(spark, path, "country", 5, blocks=4).update(spark.createDataFrame(rows, SCHEMA), epoch)
        per = defaultdict(lambda: None)
        for x in done:
            per[x[4]] = per[x[4]] if x[5] is None else (per[x[4]] or 0) + x[5]
        want = sorted(per.items(), key=lambda kv: (kv[1] is None, -(kv[1] or 0), kv[0] is None, kv[0] or ""))[:5]
        state = revenue_by(spark, path, "country", 5, blocks=4)
        assert [(r.key, r.amount) for r in state.top(5).collect()] == want
    with pytest.raises(ValueError):
        state.top(6)


def test_a_falling_sum_leaves_the_top(spark):
    path = _folder()
    state = revenue_by(spark, path, "country", 1, blocks=1)
    for epoch, rows in enumerate([[("a", 9), ("b", 5)], [("a", -6)]]):
        state.update(spark.createDataFrame([(1, "", "", "", c, Decimal(v), None) for c, v in rows], SCHEMA), epoch)
    assert state.top(1).first().key == "b"


def test_newest_rows(spark):
    path, done = _folder(), []
    for epoch in range(3):
        rows = _rows(epoch, 50)
        done += rows
        for _ in range(2):
            newest_rows(spark, path, 7).update(spark.createDataFrame(rows, SCHEMA), epoch)
    want = sorted((x[:6] for x in done), key=lambda x: (-x[0], x[1], x[2], x[3], x[4] is not None, x[4] or ""))[:7]
    got = [r.user_id for r in newest_rows(spark, path, 7).rows().collect()]
    assert sorted(got, reverse=True) == [x[0] for x in want]


def test_empty_state(spark):
    assert running_revenue(spark, _folder()).running().count() == 0
    assert newest_rows(spark, _folder()).rows().count() == 0
    state = TopRows(spark, _folder(), "a int", [F.desc("a")], 2)
    state.update(spark.createDataFrame([], "a int"), 0)
    assert state.rows().count() == 0
    sums = BlockedSums(spark, _folder(), trunc_ntz("second", F.col("registration_date")), F.col("order_amount"),
                       F.to_date, "timestamp_ntz", "date")
    sums.update(spark.createDataFrame([], SCHEMA), 0)
    assert sums.sums().count() == 0
