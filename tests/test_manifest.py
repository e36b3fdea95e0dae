"""Manifest and compaction of a landed table."""
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import log_df
from sluice.plans.catalog import USERS
from sluice.operators.spec import ColumnSpec, TableSpec
from sluice.streaming import landing as sl
from sluice.streaming import manifest
from sluice.streaming.manifest import LandedTable


def _land(spark, base, epoch, offsets, spec=USERS, value='{"user_id":%d}'):
    sl.land_batch(log_df(spark, [("u", o % 2, o, value % o) for o in offsets]), epoch, spec, base + "/t", base + "/e")


def _offsets(df):
    return sorted(r.offset for r in df.select("offset").collect())


@pytest.fixture()
def base():
    return tempfile.mkdtemp(prefix="sluice-manifest-", dir="/tmp")


def test_reads_are_the_same_before_during_and_after(spark, base):
    for e in range(9):
        _land(spark, base, e, range(3 * e, 3 * e + 3))
    table = LandedTable(spark, base + "/t")
    all_rows = list(range(27))
    assert _offsets(table.read()) == all_rows
    during = table.read()                     # planned before, read after the compaction
    m = table.compact(through=3, fan=2)
    assert m["through"] == 3 and _offsets(during) == all_rows == _offsets(table.read())
    m = table.compact(fan=2)                  # 4..7; 8 is the newest and stays
    assert m["through"] == 7 and len(m["parts"]) == 1 and m["parts"][0]["tier"] == 1 and m["parts"][0]["rows"] == 24
    assert m["parts"][0]["ranges"] == [["u", 0, 0, 22], ["u", 1, 1, 23]]
    assert _offsets(table.read()) == all_rows == _offsets(table.read(version=1))
    table.vacuum(keep=1)
    assert table.epochs() == [8] and table.versions() == [2] and _offsets(table.read()) == all_rows
    assert _offsets(table.read_offsets("u", 1, 5, 25)) == list(range(5, 26, 2))
    assert table.compact() == m               # nothing new is settled


def test_replay_of_a_compacted_epoch_adds_nothing(spark, base):
    for e in range(4):
        _land(spark, base, e, [2 * e, 2 * e + 1])
    table = LandedTable(spark, base + "/t")
    table.compact()
    table.vacuum(keep=1)
    _land(spark, base, 1, [2, 3])
    _land(spark, base, 3, [6, 7])             # the newest epoch, replayed
    assert _offsets(table.read()) == list(range(8)) and table.epochs() == [3]
    _land(spark, base, 4, [0, 5, 8])          # late re-deliveries of compacted rows
    assert _offsets(sl.read_landed(spark, base + "/t")) == list(range(9))


def test_parts_stay_few(spark, base):
    table = LandedTable(spark, base + "/t")
    rows = log_df(spark, [("u", 0, 0, "")]).select("topic", "partition", "offset")
    for e in range(20):
        sl._write_epoch(rows.selectExpr("topic", "partition", f"cast({e} as long) offset"), base + "/t", e)
        table.compact(fan=2)
        table.vacuum(keep=1)
    parts = table.manifest()["parts"]
    assert len(parts) <= 5 and sum(p["rows"] for p in parts) == 19
    assert _offsets(table.read()) == list(range(20)) and len(table.files.names(table.parts)) == len(parts)


def test_many_epochs_at_once(spark, base):
    rows = spark.range(0, 1000).selectExpr("'u' topic", "0 partition", "id offset", "id _epoch")
    rows.repartition(1).write.partitionBy("_epoch").parquet(base + "/t")
    table = LandedTable(spark, base + "/t")
    assert len(table.epochs()) == 1000
    table.compact()
    table.vacuum(keep=1)
    assert table.epochs() == [999] and len(table.manifest()["parts"]) == 1
    assert _offsets(table.read()) == list(range(1000))


def test_columns_that_came_later(spark, base):
    spec = TableSpec("t", (ColumnSpec("a", "bigint"),), evolve=True)
    for e, value in enumerate(['{"a":%d}', '{"a":%d,"b":1}', '{"a":%d}', '{"a":%d}']):
        _land(spark, base, e, [e], spec, value)
    table = LandedTable(spark, base + "/t")
    table.compact()
    table.vacuum(keep=1)
    _land(spark, base, 4, [4], spec, '{"a":%d,"b":"x"}')   # b keeps its landed type: an error row
    assert {r.offset: r.b for r in table.read().select("offset", "b").collect()} == {0: None, 1: 1, 2: None, 3: None}


def test_empty_table_and_lost_race(spark, base):
    table = LandedTable(spark, base + "/t")
    assert table.read() is None and table.compact()["version"] == 0
    table.vacuum()
    for e in range(3):
        _land(spark, base, e, [e])
    table.compact(through=0)
    with pytest.raises(FileExistsError):
        table.files.publish(f"{table.manifests}/v{1:09d}.json", "{}")
    assert _offsets(table.read()) == [0, 1, 2]


def test_repetitive_rows_are_sorted_by_several_tasks(spark, base, monkeypatch):
    monkeypatch.setattr(manifest, "SORT_BYTES", 100_000, raising=False)
    table = LandedTable(spark, base + "/t")
    rows = spark.range(3000).selectExpr("'u' topic", "0 partition", "id offset", "repeat('x', 100) text", "array('y') `a.b`")
    for e in range(2):
        rows.repartition(3).write.parquet(f"{base}/t/_epoch={e}")
    part = table.compact()["parts"][0]["path"]
    files = spark.read.parquet(f"{base}/t-parts/{part}").select("*", "_metadata.file_path").groupBy("file_path").agg(
        F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi")).orderBy("lo").collect()
    assert len(files) > 3 and sum(f.n for f in files) == 3000 and max(f.n for f in files) < 1500
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))
