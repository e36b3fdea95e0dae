"""Semantic view: names, synonyms, comments and queries."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators.semantic import users_view

ROWS = [(1, "US", "CA", "SF", "2000-12-31", "2024-01-01 10:15:00", "10.00"),
        (2, "US", "NY", "NYC", "1950-06-01", "2024-01-01 10:45:00", "30.00"),
        (3, "FR", "IDF", "Paris", "1985-01-01", "2024-01-01 11:05:00", "20.00")]


def _users(spark):
    return spark.createDataFrame(
        ROWS, "user_id long, country string, state string, city string, date_of_birth string, "
              "registration_date string, order_amount string") \
        .select("user_id", "country", "state", "city",
                F.col("date_of_birth").cast("date").alias("date_of_birth"),
                F.col("registration_date").cast("timestamp_ntz").alias("registration_date"),
                F.col("order_amount").cast("decimal(10,2)").alias("order_amount"))


def test_synonyms_resolve():
    v = users_view()
    assert v.resolve("revenue") == "total_revenue"
    assert v.resolve("sales") == "total_revenue"
    assert v.resolve("town") == "city"
    assert v.resolve("users.country") == "country"
    assert v.resolve("DOB") == "date_of_birth"
    with pytest.raises(KeyError):
        v.resolve("no such thing")


def test_counts_of_view_items():
    v = users_view()
    assert (len(v.facts), len(v.dimensions), len(v.metrics)) == (2, 13, 8)
    assert v.comments()["age_group"] == "Age group bucket for the user"


def test_showcase_queries(spark):
    v, u = users_view(), _users(spark)
    t = v.query(u, [], ["total_users", "total_revenue", "avg_order_value"]).first()
    assert (t.total_users, t.total_revenue, t.avg_order_value) == (3, 60.0, 20.0)
    top = v.query(u, ["country"], ["revenue", "user count"], order_by=[F.desc("total_revenue")], limit=5)
    assert [(r.country, r.total_revenue, r.total_users) for r in top.collect()] == [("US", 40.0, 2), ("FR", 20.0, 1)]
    hours = v.query(u, ["registration_hour"], ["total_users"], order_by=["registration_hour"]).collect()
    assert [(r.registration_hour, r.total_users) for r in hours] == [
        (dt.datetime(2024, 1, 1, 10), 2), (dt.datetime(2024, 1, 1, 11), 1)]


def test_age_counts_year_boundaries(spark):
    v, u = users_view(), _users(spark)
    got = {r.user_id: (r.age, r.g) for r in u.select(
        "user_id", v.dimension("age", "2001-01-01").alias("age"),
        v.dimension("age_group", "2001-01-01").alias("g")).collect()}
    assert got[1] == (1, "18-24") and got[2] == (51, "45-54")


def test_cdr_view_synonyms():
    from sluice.operators.semantic import cdr_view
    v = cdr_view()
    assert v.resolve("tower") == "cell_tower_id"
    assert v.resolve("call drop rate") == "drop_rate"
    assert v.resolve("data usage") == "total_data_usage_mb"


def test_filters_by_dimension_names_and_synonyms(spark):
    v, u = users_view(), _users(spark)
    got = v.query(u, ["nation"], ["user count"], filters={"age bracket": ["18-24", "45-54"]},
                  as_of="2001-01-01").collect()
    assert sorted((r.country, r.total_users) for r in got) == [("FR", 1), ("US", 2)]
    got = v.query(u, [], ["revenue"], filters={"province": "IDF"}).first()
    assert got.total_revenue == 20.0
