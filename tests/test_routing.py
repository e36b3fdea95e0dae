"""Topic -> table routing and name sanitisation."""
from pyspark.sql import functions as F

from sluice.operators.shaping import parse_topic_map, route_topics


def _route(spark, mapping, topics, sanitize=True):
    df = spark.createDataFrame([(t,) for t in topics], "topic string")
    return [r.t for r in df.select(route_topics(F.col("topic"), mapping, sanitize).alias("t")).collect()]


def test_parse_quoted_entries():
    assert parse_topic_map('"my:topic":"My_Table",a:T1') == [("my:topic", "My_Table"), ("a", "T1")]


def test_routing_cases(spark):
    assert _route(spark, "orders:ORDER_TABLE,customers:CUSTOMER_TABLE", ["orders"]) == ["ORDER_TABLE"]
    assert _route(spark, "topic1:SHARED_TABLE,topic2:SHARED_TABLE,topic3:SHARED_TABLE",
                  ["topic3"]) == ["SHARED_TABLE"]
    assert _route(spark, ".*_events:ALL_EVENTS", ["click_events", "clicks"]) == ["ALL_EVENTS", "CLICKS"]
    assert _route(spark, '"my:topic":"My_Table"', ["my:topic"]) == ["My_Table"]
    assert _route(spark, "", ["orders-prod"]) == ["ORDERS_PROD"]
    assert _route(spark, "", ["orders-prod"], sanitize=False) == ["orders-prod"]


def test_explicit_entry_beats_regex(spark):
    assert _route(spark, ".*_events:ALL,click_events:CLICKS", ["click_events"]) == ["CLICKS"]
