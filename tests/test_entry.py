"""The driver contract and a sample of catalog queries on sf0.001."""
import __spark_entry__ as entry
from conftest import SF_SMALL

from sluice.plans.catalog import QUERIES


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["country", "revenue"] and 0 < len(rows) <= 10


def test_every_query_has_an_oracle_or_is_rows_only():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert (set(qs) - set(sql)) & set(QUERIES) == {"rollup_latency_daily"}


def test_catalog_queries_build_and_run(spark):
    for name in ("land_by_name", "error_table", "channel_status", "cumulative_revenue", "tower_forecast",
                 "dedup_keep_first", "evolve_schema", "record_content"):
        df = entry.queries()[name](spark, SF_SMALL)
        assert df.count() >= 0, name
