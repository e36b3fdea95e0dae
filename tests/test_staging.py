"""Staged logs of the streaming queries: files that grow in number, not in size."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sluice.plans import catalog


@pytest.mark.parametrize("query", ["stream_dedup", "stream_dedup_intervals"])
def test_one_hot_log_partition_is_staged_in_several_files(spark, monkeypatch, query):
    sf = tempfile.mkdtemp(prefix="sluice-sf-", dir="/tmp")
    (spark.range(2000).selectExpr("id event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) ts",
                                  "cast(3 as bigint) user_id", "'view' event_type", "cast(id as double) value", "'{}' props")
     .write.parquet(os.path.join(sf, "events.parquet")))
    staged = []
    stage = catalog._stage_input
    monkeypatch.setattr(catalog, "STAGED_RECORDS", 250, raising=False)
    monkeypatch.setattr(catalog, "_stage_input", lambda *a: staged.append(stage(*a)) or staged[-1])
    out = catalog.QUERIES[query](spark, sf)
    assert out.count() == 2000 == out.select("offset").distinct().count()
    records = spark.read.parquet(staged[0]).select("*", "_metadata.file_path")
    files = [r["count"] for r in records.groupBy("file_path").count().collect()]
    assert sum(files) == 2200 and max(files) < 600      # one file of 2,200 before
    assert records.groupBy("topic", "partition", "offset").agg(F.count_distinct("file_path").alias("n")).where("n > 1").isEmpty()
