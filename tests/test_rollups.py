"""Mergeable roll-ups against exact figures."""
import datetime as dt
import random
from bisect import bisect_left, bisect_right

from pyspark.sql import functions as F

from sluice.operators import rollups

SCHEMA = "at timestamp_ntz, who long, ms double, dim string"


def _rows(n):
    r = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    return [(start + dt.timedelta(minutes=r.randrange(2 * 24 * 60)), r.randrange(20_000), r.lognormvariate(3, 1), r.choice(["a", "b"])) for _ in range(n)]


def _hours(df):
    return rollups.hourly(df, F.col("at"), {"who": F.col("who"), "dim": F.col("dim")}, {"ms": F.col("ms")}, by=["dim"])


def test_merged_hours_stay_within_the_bounds(spark):
    rows = _rows(40_000)
    hours = _hours(spark.createDataFrame(rows, SCHEMA))
    days = rollups.merged(hours, [F.to_date("hour").alias("day")])
    got = {r.day: r for r in rollups.figures(days, (0.5, 0.9, 0.99)).collect()}
    assert len(got) == 2
    for day, g in got.items():
        mine = [x for x in rows if x[0].date() == day]
        assert g.n_rows == len(mine) and g.unique_dim == 2
        exact = len({x[1] for x in mine})
        assert abs(g.unique_who - exact) <= 0.06 * exact
        ms = sorted(x[2] for x in mine)
        for p, v in ((0.5, g.ms_p50), (0.9, g.ms_p90), (0.99, g.ms_p99)):
            low, high = bisect_left(ms, v) / len(ms), bisect_right(ms, v) / len(ms)
            assert low - 0.01 <= p <= high + 0.01, (p, low, high)


def test_merging_twice_equals_merging_once(spark):
    hours = _hours(spark.createDataFrame(_rows(3000), SCHEMA))
    once = rollups.figures(rollups.merged(hours)).first()
    twice = rollups.figures(rollups.merged(rollups.merged(hours, ["dim", F.to_date("hour").alias("day")]))).first()
    assert once.n_rows == twice.n_rows == 3000 and once.unique_dim == twice.unique_dim == 2
    assert abs(once.unique_who - twice.unique_who) <= 0.03 * once.unique_who


def test_few_values_are_exact(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(at + dt.timedelta(hours=k), k % 7, float(k), "a") for k in range(21)], SCHEMA)
    r = rollups.figures(rollups.merged(_hours(df))).first()
    assert (r.n_rows, r.unique_who, r.ms_p50, r.ms_p99) == (21, 7, 10.0, 20.0)


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, None, None, None), (dt.datetime(2024, 1, 1), 1, None, "a")], SCHEMA)
    got = {r.dim: r for r in rollups.figures(_hours(df)).collect()}
    assert got[None].hour is None and got[None].n_rows == 1 and got[None].unique_who == 0 and got[None].ms_p99 is None
    assert got["a"].unique_who == 1 and got["a"].ms_p50 is None
    assert rollups.figures(_hours(df.limit(0))).count() == 0
