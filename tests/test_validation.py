"""Validation, error tables, dead letters, tolerance and mode rules."""
import pytest
from pyspark.sql import functions as F

from conftest import log_df
from sluice.operators import landing, shaping
from sluice.plans.catalog import FIXES, USERS

GOOD = ('{"user_id":200,"first_name":"A","date_of_birth":"1990-01-02",'
        '"registration_date":"2024-01-01T10:00:00","order_amount":12.5}')
BAD = ('{"user_id":"BAD_ID","first_name":"A","date_of_birth":"INVALID_DATE",'
       '"registration_date":"INVALID_TS","order_amount":1}')


def _validated(spark, values):
    df = log_df(spark, [("users", 0, i, v) for i, v in enumerate(values)])
    return landing.validate(df, USERS, keep=("topic", "partition", "offset", "key", "push_time"),
                            text_fixes=FIXES)


def test_injected_row_gives_one_error_row_with_three_reasons(spark):
    v = _validated(spark, [GOOD, BAD, GOOD])
    good, bad = landing.split_errors(v, F.lit(None).cast("timestamp_ntz"), ("offset",))
    assert good.count() == 2
    rows = bad.collect()
    assert len(rows) == 1 and rows[0].offset == 1 and rows[0].n_reasons == 3
    assert rows[0].error_reasons == ("user_id:invalid_bigint;date_of_birth:invalid_date;"
                                     "registration_date:invalid_timestamp")


def test_rows_are_conserved(spark):
    vals = [GOOD, BAD, None, "not-json", "{}", '{"city":"' + "x" * 101 + '"}']
    v = _validated(spark, vals)
    good, bad = landing.split_errors(v, F.lit(None).cast("timestamp_ntz"), ("offset",))
    assert good.count() + bad.count() == len(vals)
    reasons = {r.offset: r.error_reasons for r in bad.collect()}
    assert reasons[2] == "null_value" and reasons[3] == "not_an_object"
    assert reasons[5] == "city:too_long"


def test_loose_casts_are_refused(spark):
    vals = ['{"user_id":" 42 "}', '{"user_id":4.2}', '{"date_of_birth":"2026"}', '{"user_id":"+7"}']
    rows = {r.offset: r for r in _validated(spark, vals).collect()}
    assert rows[0].user_id is None and rows[1].user_id is None
    assert rows[2].date_of_birth is None and rows[3].user_id == 7


def test_dead_letters_keep_original_record(spark):
    v = _validated(spark, [GOOD, BAD])
    d = landing.dead_letters(v, ("offset", "key")).collect()
    assert len(d) == 1 and d[0].value == BAD and d[0].dlq_reason == "user_id:invalid_bigint"


def test_tolerance(spark):
    v = _validated(spark, [GOOD, BAD])
    with pytest.raises(landing.ToleranceError):
        landing.raise_if_errors(v)
    good, dlq, dropped = landing.apply_tolerance(v, "all", dlq=False)
    assert dlq is None and good.count() == 1
    assert v.agg(dropped).first().dropped_rows == 1
    good, dlq, _ = landing.apply_tolerance(v, "all", dlq=True)
    assert dlq.count() == 1
    with pytest.raises(ValueError):
        landing.apply_tolerance(v, "some", dlq=True)


def test_client_side_with_user_pipe_is_refused():
    with pytest.raises(ValueError):
        landing.check_mode("client_side", user_pipe=True)
    landing.check_mode("server_side", user_pipe=True)


def test_identifier_normalisation(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert shaping.normalize_identifiers(df).columns == ["A", "B"]
    with pytest.raises(ValueError):
        shaping.normalize_identifiers(spark.createDataFrame([(1, 2)], "`a` int, `A_` int")
                                      .toDF("a", "A"))


def test_default_ingestion_time(spark):
    df = spark.createDataFrame([(None,), ("2024-01-01 00:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"))
    out = landing.with_default(df, "t", F.expr("TIMESTAMP_NTZ'2030-01-01 00:00:00'")).collect()
    assert str(out[0].t) == "2030-01-01 00:00:00"


def test_unknown_fields(spark):
    df = log_df(spark, [("u", 0, 0, '{"user_id":1,"Extra":2}'), ("u", 0, 1, '{"EXTRA":3,"x":1}')])
    got = {r.unknown_key: r.n_records for r in landing.unknown_field_counts(df, USERS).collect()}
    assert got == {"Extra": 1, "EXTRA": 1, "x": 1}
