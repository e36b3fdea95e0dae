"""Landing: parse JSON payloads, match declared columns by name, validate,
split good rows from error rows, and shape the landed rows.

All of it is column expressions over one pass of the input; nothing shuffles.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import casts
from sluice.functions.json_fields import (lowered_key_list, parse_object, position_of, unknown_keys,
                                         value_at)
from sluice.functions.plan import fence
from sluice.functions.timefn import lit_ntz
from sluice.operators.spec import TableSpec

PAYLOAD = "__payload"
LOWERED = "__lowered"


# -- P1 / V11 ---------------------------------------------------------------

def with_payload(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the parsed payload map (NULL when the value is not a JSON object)."""
    return df.withColumn(PAYLOAD, parse_object(F.col(value)))


def parse_or_raw(df: DataFrame, value: str = "value",
                 keep: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """Parse each record; a record that is not a JSON object keeps its text as
    ``raw_data`` (the consumer's fallback), an object reports its key count."""
    d = with_payload(df, value)
    is_obj = F.col(PAYLOAD).isNotNull()
    return d.select(*keep,
                    is_obj.alias("is_object"),
                    F.when(~is_obj, F.col(value)).alias("raw_data"),
                    F.when(is_obj, F.size(PAYLOAD)).cast("int").alias("n_keys"))


def payload_class(value: Column) -> Column:
    """Class of a record value: tombstone, empty, object, null_literal, array,
    broken (starts like an object but does not parse) or text."""
    t = F.trim(value)
    return (F.when(value.isNull(), F.lit("tombstone"))
            .when(t == "", F.lit("empty"))
            .when(parse_object(value).isNotNull(), F.lit("object"))
            .when(t == "null", F.lit("null_literal"))
            .when(t.startswith("["), F.lit("array"))
            .when(t.startswith("{"), F.lit("broken"))
            .otherwise(F.lit("text")))


def malformed_classes(df: DataFrame, value: str = "value") -> DataFrame:
    return (df.groupBy(payload_class(F.col(value)).alias("payload_class"))
            .agg(F.count(F.lit(1)).alias("n_records")))


# -- P2 / P13 / V10 ----------------------------------------------------------

def with_lowered(df: DataFrame) -> DataFrame:
    """Add the reversed, lower-cased key list of the payload and its size.

    Case-insensitive matching then needs no lambdas: each declared column is
    a position lookup in this list (first hit = last key in the payload, so
    the last of keys differing by case wins) and an element access -- both
    inside whole-stage codegen. The list is its own projection so that only
    it is evaluated outside codegen.
    """
    return (df.withColumn(LOWERED, F.reverse(lowered_key_list(F.col(PAYLOAD))))
              .withColumn("__n_keys", F.size(F.col(LOWERED))))


def raw_fields(df: DataFrame, spec: TableSpec) -> list[Column]:
    """The payload text of every declared column, matched case-insensitively
    (needs :func:`with_payload` and :func:`with_lowered` first)."""
    return [value_at(F.col(PAYLOAD), F.col("__n_keys"), F.col(f"__pos_{c.name}")).alias(f"__raw_{c.name}")
            for c in spec.columns]


def with_raw_fields(df: DataFrame, spec: TableSpec, keep: Sequence[str]) -> DataFrame:
    """``keep``, the payload internals and each declared column's position in
    the reversed key list (``df`` must already have the payload)."""
    d = with_lowered(df)
    cols = list(dict.fromkeys([*keep, PAYLOAD, LOWERED, "__n_keys"]))
    return d.select(*cols, *[position_of(F.col(LOWERED), c.name).alias(f"__pos_{c.name}")
                             for c in spec.columns])


def typed(spec: TableSpec, text_fixes: dict[str, Column] | None = None) -> list[Column]:
    out = []
    for c in spec.columns:
        v = casts.cast_text(F.col(f"__raw_{c.name}"), c.type)
        if text_fixes and c.name in text_fixes:
            v = text_fixes[c.name](v)
        out.append(v.alias(c.name))
    return out


def newline_to_comma(c: Column) -> Column:
    """Producers flatten multi-line addresses: newline -> ', '."""
    return F.regexp_replace(c, r"\r?\n", ", ")


def land_by_name(df: DataFrame, spec: TableSpec, as_of: str | _dt.datetime | None = None,
                 keep: Sequence[str] = (), text_fixes: dict | None = None,
                 value: str = "value") -> DataFrame:
    """MATCH_BY_COLUMN_NAME landing: extra keys are ignored, missing keys and
    explicit nulls land as NULL; ``ingestion_time`` defaults to ``as_of``."""
    d = with_raw_fields(with_payload(df, value), spec, keep)
    d = d.select(*keep, *raw_fields(d, spec))
    cols = [*keep, *typed(spec, text_fixes)]
    out = d.select(*cols)
    if as_of is None:
        return out
    if "ingestion_time" in out.columns:  # a sent value stays
        return with_default(out, "ingestion_time", lit_ntz(as_of))
    return out.withColumn("ingestion_time", lit_ntz(as_of))


def with_default(df: DataFrame, column: str, default: Column) -> DataFrame:
    """``DEFAULT`` at landing: fill a missing value."""
    return df.withColumn(column, F.coalesce(F.col(column), default))


# -- V1 / V2 / V3 / V4 / V9 ---------------------------------------------------

def reason_columns(spec: TableSpec, value: str = "value") -> list[Column]:
    """One nullable reason per check, in a fixed order."""
    rs = [F.when(F.col(value).isNull(), F.lit("null_value")),
          F.when(F.col(value).isNotNull() & F.col(PAYLOAD).isNull(), F.lit("not_an_object"))]
    for c in spec.columns:
        raw = F.col(f"__raw_{c.name}")
        if c.kind != "string":
            rs.append(F.when(raw.isNotNull() & F.col(c.name).isNull(),
                             F.lit(f"{c.name}:invalid_{c.kind}")))
        if c.max_length is not None:
            rs.append(F.when(F.char_length(F.col(c.name)) > c.max_length,
                             F.lit(f"{c.name}:too_long")))
    return rs


def validate(df: DataFrame, spec: TableSpec, keep: Sequence[str] = (),
             value: str = "value", text_fixes: dict | None = None) -> DataFrame:
    """Land by name and attach ``error_reasons`` (array) and ``is_valid``."""
    keep_v = list(dict.fromkeys([*keep, value]))
    d = with_raw_fields(with_payload(df, value), spec, keep_v)
    d = d.select(*keep_v, PAYLOAD, *raw_fields(d, spec))
    d = d.select("*", *typed(spec, text_fixes))
    # NULL-free reason list without a lambda (reasons are distinct strings,
    # so the set difference keeps them all, in order)
    reasons = F.array_except(F.array(*reason_columns(spec, value)), F.array(F.lit(None).cast("string")))
    out = d.withColumn("error_reasons", reasons)
    drop = [f"__raw_{c.name}" for c in spec.columns] + [PAYLOAD]
    return fence(out.withColumn("is_valid", F.size("error_reasons") == 0).drop(*drop))


def type_errors(validated: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows with at least one type error, and which columns failed (V1)."""
    te = F.filter("error_reasons", lambda x: x.contains(":invalid_"))
    return (validated.select(*keep, te.alias("__te"))
            .where(F.size("__te") > 0)
            .select(*keep, F.array_join("__te", ";").alias("type_errors"),
                    F.size("__te").cast("int").alias("n_type_errors")))


def length_errors(validated: DataFrame, spec: TableSpec, keep: Sequence[str]) -> DataFrame:
    """Rows with a string longer than its declared VARCHAR length (V2)."""
    limited = [c for c in spec.columns if c.max_length is not None]
    over = F.array_except(F.array(*[F.when(F.char_length(c.name) > c.max_length, F.lit(c.name))
                                    for c in limited]), F.array(F.lit(None).cast("string")))
    return (validated.select(*keep, over.alias("__over"),
                             F.greatest(*[F.char_length(c.name) for c in limited]).alias("__len"))
            .where(F.size("__over") > 0)
            .select(*keep, F.array_join("__over", ";").alias("too_long_columns"),
                    F.col("__len").cast("int").alias("max_length_seen")))


def split_errors(validated: DataFrame, error_time: Column,
                 keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Server-side validation: good rows go to the table, the others to
    ``<T>_ERRORS`` with their reasons and ``error_timestamp``."""
    good = validated.where(F.col("is_valid")).drop("error_reasons", "is_valid")
    bad = (validated.where(~F.col("is_valid"))
           .select(*keep,
                   F.array_join("error_reasons", ";").alias("error_reasons"),
                   F.size("error_reasons").cast("int").alias("n_reasons"),
                   error_time.alias("error_timestamp")))
    return good, bad


def dead_letters(validated: DataFrame, keep: Sequence[str], value: str = "value") -> DataFrame:
    """Client-side validation: the original record plus the first reason goes
    to the dead-letter sink."""
    return (validated.where(~F.col("is_valid"))
            .select(*keep, value,
                    F.element_at("error_reasons", 1).alias("dlq_reason")))


TOLERANCE = ("none", "all")


class ToleranceError(RuntimeError):
    pass


def apply_tolerance(validated: DataFrame, tolerance: str, dlq: bool) -> tuple[DataFrame, DataFrame | None, Column]:
    """``errors.tolerance``: ``none`` fails on the first bad row, ``all`` goes on
    (bad rows to the DLQ when one is configured; otherwise they are dropped but
    *counted*: the returned Column is an ``observe`` metric of dropped rows).

    With ``none`` the check is an action on the error count, done by the caller
    through :func:`raise_if_errors`.
    """
    if tolerance not in TOLERANCE:
        raise ValueError(f"errors.tolerance must be one of {TOLERANCE}")
    dropped = F.count_if(~F.col("is_valid")).alias("dropped_rows")
    good = validated.where(F.col("is_valid"))
    if tolerance == "all" and dlq:
        return good, validated.where(~F.col("is_valid")), dropped
    return good, None, dropped


def raise_if_errors(validated: DataFrame) -> None:
    n = validated.where(~F.col("is_valid")).limit(1).count()
    if n:
        raise ToleranceError("errors.tolerance=none and the batch has invalid rows")


def check_mode(validation: str, user_pipe: bool) -> None:
    """Client-side validation cannot be combined with a user-defined pipe."""
    if validation not in ("server_side", "client_side"):
        raise ValueError("validation must be server_side or client_side")
    if validation == "client_side" and user_pipe:
        raise ValueError("client-side validation is not supported with a user-defined pipe")


def unknown_field_counts(df: DataFrame, spec: TableSpec, value: str = "value") -> DataFrame:
    """With evolution off, keys that match no declared column are reported."""
    d = with_payload(df, value)
    return (d.select(F.explode(unknown_keys(F.col(PAYLOAD), spec.names)).alias("unknown_key"))
            .groupBy("unknown_key").agg(F.count(F.lit(1)).alias("n_records")))


def null_profile(landed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count per landed column (one pass, then unpivot)."""
    agg = landed.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.unpivot([], list(columns), "column_name", "null_count") \
              .select("column_name", F.col("null_count").cast("bigint").alias("null_count"))
