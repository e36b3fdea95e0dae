"""Payload cases: parse, match by name, malformed classes."""
from pyspark.sql import functions as F

from conftest import log_df
from sluice.functions.json_fields import parse_object, pick
from sluice.operators import landing
from sluice.operators.spec import TableSpec

C1 = TableSpec.from_tuples("t", [("c1", "bigint", None), ("c2", "string", 10)])


def _land(spark, values):
    df = log_df(spark, [("t", 0, i, v) for i, v in enumerate(values)])
    out = landing.land_by_name(df, C1, keep=("offset",)).orderBy("offset")
    return [tuple(r) for r in out.collect()]


def test_case_insensitive_match_and_last_wins(spark):
    got = _land(spark, ['{"C1":1}', '{"C1":1,"c1":2}', '{"c1":1} trailing', '{"a":1,"a":2,"c1":3}'])
    assert [r[1] for r in got] == [1, 2, 1, 3]


def test_missing_null_and_empty_land_as_null(spark):
    got = _land(spark, ['{}', '{"c2":"x"}', '{"c1":null,"c2":null}'])
    assert [(r[1], r[2]) for r in got] == [(None, None), (None, "x"), (None, None)]


def test_non_objects_go_to_raw_data(spark):
    vals = ["not-json", "not json at all", "{broken json: ", "", "null", "[1, 2, 3]", '{"c1":5}']
    df = log_df(spark, [("t", 0, i, v) for i, v in enumerate(vals)])
    out = {r.offset: r for r in landing.parse_or_raw(df).collect()}
    for i, v in enumerate(vals[:-1]):
        assert out[i].is_object is False and out[i].raw_data == v
    assert out[6].is_object is True and out[6].raw_data is None and out[6].n_keys == 1


def test_malformed_classes(spark):
    vals = ["not-json", "{broken json: ", "", "null", "[1, 2, 3]", "{}", None, '{"a":1}']
    df = log_df(spark, [("t", 0, i, v) for i, v in enumerate(vals)])
    got = {r.payload_class: r.n_records for r in landing.malformed_classes(df).collect()}
    assert got == {"text": 1, "broken": 1, "empty": 1, "null_literal": 1, "array": 1,
                   "object": 2, "tombstone": 1}


def test_nested_path_with_spaced_key(spark):
    df = spark.createDataFrame([('{"p":{"c d":5},"f n":"x"}',)], "value string")
    v = F.try_parse_json("value")
    r = df.select(F.try_variant_get(v, '$.p["c d"]', "int").alias("a"),
                  F.try_variant_get(v, "$['f n']", "string").alias("b")).first()
    assert (r.a, r.b) == (5, "x")


def test_nested_value_comes_out_as_json_text(spark):
    df = spark.createDataFrame([('{"P":{"c d":5},"A":[1,2]}',)], "value string")
    m = parse_object(F.col("value"))
    r = df.select(pick(m, "p").alias("p"), pick(m, "a").alias("a")).first()
    assert (r.p, r.a) == ('{"c d":5}', "[1,2]")


def test_large_json_numbers_land_as_decimal(spark):
    spec = TableSpec.from_tuples("t", [("amt", "decimal(12,2)", None)])
    df = log_df(spark, [("t", 0, 0, '{"amt":12345678.9}'), ("t", 0, 1, '{"amt":0.0005}')])
    out = landing.validate(df, spec, keep=("offset",)).orderBy("offset").collect()
    assert float(out[0].amt) == 12345678.9 and out[0].is_valid
    assert float(out[1].amt) == 0.0 and out[1].is_valid


def test_three_client_time_forms(spark):
    from sluice.functions.casts import to_timestamp_any
    vals = ["2024-01-01T00:00:07.179575", "2024-01-01T00:00:07.179Z", "1704067207.179575",
            "1.704067207179575E9", "2024-01-01 00:00:07", "INVALID_TS", "2026"]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.createDataFrame([(v,) for v in vals], "t string")
        got = [str(r.x) if r.x else None for r in df.select(to_timestamp_any(F.col("t")).alias("x")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got[:5] == ["2024-01-01 00:00:07.179575", "2024-01-01 00:00:07.179000", "2024-01-01 00:00:07.179575",
                       "2024-01-01 00:00:07.179575", "2024-01-01 00:00:07"]
    assert got[5] is None
    assert got[6] == "1970-01-01 00:33:46"   # a bare number is epoch seconds


def test_key_with_separator_character_still_matches(spark):
    got = _land(spark, ['{"a\\u0000b":1,"C1":2}', '{"C1":3,"x\\u0000":4,"c1":5}'])
    assert [r[1] for r in got] == [2, 5]
