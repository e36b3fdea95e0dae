"""Interval sets of offsets: against plain Python sets, over batches, late and replayed."""
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, log_df
from sluice.operators import intervals as iv
from sluice.plans.catalog import USERS
from sluice.sources import fixtures as fx
from sluice.sources.log_source import file_stream
from sluice.streaming import intervals as si
from sluice.streaming import landing as sl


def runs(offsets):
    out = []
    for o in sorted(set(offsets)):
        if out and out[-1][1] == o - 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    return [tuple(r) for r in out]


def rows(df):
    got = {}
    for r in df.collect():
        got.setdefault((r.topic, r.partition), []).append((r.lo, r.hi))
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("block", [1, 4, 1 << 16])
def test_intervals_by_plain_sets(spark, block):
    rnd = random.Random(block)
    held = {("t", p): [rnd.randrange(120) for _ in range(n)] for p, n in ((0, 200), (1, 40), (2, 1))}
    df = spark.createDataFrame([(t, p, o) for (t, p), os in held.items() for o in os] + [(None, 0, 5), ("t", None, 5), ("t", 0, None)],
                               "topic string, partition int, offset long")
    got = iv.offset_intervals(df, block_size=block)
    assert rows(got) == {k: runs(v) for k, v in held.items()}
    probe = spark.createDataFrame([("t", p, o) for p in range(4) for o in range(125)] + [(None, 0, 5), ("t", 0, None)], "topic string, partition int, offset long")
    left = [(r.topic, r.partition, r.offset) for r in iv.not_in(probe, got, block_size=block).collect()]
    assert sorted(left, key=str) == sorted([("t", p, o) for p in range(4) for o in range(125) if o not in held.get(("t", p), [])]
                                           + [(None, 0, 5), ("t", 0, None)], key=str)
    assert iv.offset_intervals(df.limit(0)).count() == 0


def test_merge_of_overlapping_and_adjacent(spark):
    r = spark.createDataFrame([("t", 0, 1, 3), ("t", 0, 4, 6), ("t", 0, 2, 9), ("t", 0, 11, 12), ("t", 0, 12, 12), ("t", 1, 5, 5), (None, 1, 5, 5)], si.SCHEMA)
    assert rows(iv.merge_intervals(r)) == {("t", 0): [(1, 9), (11, 12)], ("t", 1): [(5, 5)], (None, 1): [(5, 5)]}


@pytest.mark.parametrize(("offsets", "committed", "want"), [
    ([0, 1, 2, 5], None, (3, 2, True)), ([0, 1, 2], None, (3, 0, False)), ([7, 8], None, (9, 0, False)),
    ([0, 1, 2, 5], 1, (3, 2, True)), ([5, 6], 1, (2, 3, True)), ([0, 1], 9, (10, 0, False)), ([0, 1, 2, 5], 4, (6, 0, False)), ([0, 3, 5], 0, (1, 3, True))])
def test_commit_stops_at_the_first_gap(spark, offsets, committed, want):
    """Committing highest + 1 would pass over lost records; the confirmed prefix does not."""
    r = iv.offset_intervals(log_df(spark, [("t", 0, o, "{}") for o in offsets]))
    progress = None if committed is None else spark.createDataFrame([("t", 0, committed)], "topic string, partition int, committed long")
    got = iv.contiguous_commits(r, progress).first()
    assert (got.next_offset, got.missing, got.held_back) == want


def _dedup(spark, src, out, ckpt):
    si.start_dedup(file_stream(spark, src, max_files_per_trigger=1), out, ckpt, {"availableNow": True}).awaitTermination(120)


def test_stream_dedup_equals_batch_over_late_batches_and_a_restart(spark):
    base = tempfile.mkdtemp(prefix="sluice-iv-", dir="/tmp")
    src, out, ckpt = base + "/in", base + "/out", base + "/ckpt"
    recs = fx.log_records_dup(spark, SF_SMALL)
    late = recs.where(F.col("offset") % 3 == 0)
    recs.where(F.col("offset") % 3 != 0).repartition(2).write.parquet(src)
    _dedup(spark, src, out, ckpt)
    late.unionByName(recs.where(F.col("offset") % 5 == 0)).repartition(2).write.mode("append").parquet(src)
    _dedup(spark, src, out, ckpt)
    _dedup(spark, src, out, ckpt)
    got = spark.read.parquet(out)
    keys = ["topic", "partition", "offset"]
    assert got.count() == got.select(*keys).distinct().count() == recs.select(*keys).distinct().count()
    store = si.IntervalStore(spark, ckpt + "-intervals")
    state = store.before(1 << 40)
    assert len(store.epochs()) <= 2 and state.count() == recs.select("topic", "partition").distinct().count()  # no gap left: one row each


def test_replayed_epoch_gives_the_same_rows(spark):
    base = tempfile.mkdtemp(prefix="sluice-iv-", dir="/tmp")
    store = si.IntervalStore(spark, base + "/sets")
    first, second = (log_df(spark, [("t", 0, o, "{}") for o in os]) for os in ([0, 1, 4], [1, 2, 4, 5, 2]))
    si.dedup_batch(first, 0, base + "/out", store)
    for _ in range(3):
        si.dedup_batch(second, 1, base + "/out", store)
    assert sorted(r.offset for r in spark.read.parquet(base + "/out").collect()) == [0, 1, 2, 4, 5]
    assert rows(store.before(2)) == {("t", 0): [(0, 2), (4, 5)]}


def test_landing_reads_no_landed_row_again(spark):
    base = tempfile.mkdtemp(prefix="sluice-iv-", dir="/tmp")
    target, errors = base + "/landed", base + "/errors"
    value = '{"user_id":%d}'
    for epoch, offsets in enumerate(([0, 1, 2], [2, 9], [1, 3, 9, 10], [])):
        sl.land_batch(log_df(spark, [("u", 0, o, value % o) for o in offsets]), epoch, USERS, target, errors)
    assert sorted(r.offset for r in sl.read_landed(spark, target).collect()) == [0, 1, 2, 3, 9, 10]
    assert rows(si.IntervalStore(spark, target + "-intervals").before(9)) == {("u", 0): [(0, 3), (9, 10)]}
    # a table landed without sets: they are made from its rows
    sl.land_batch(log_df(spark, [("u", 0, o, value % o) for o in (3, 11)]), 9, USERS, target, errors, intervals=base + "/other")
    assert sorted(r.offset for r in sl.read_landed(spark, target).collect()) == [0, 1, 2, 3, 9, 10, 11]
