"""Strict casts from text.

Spark's loose casts accept shapes other engines (and the JVM clients of the
landing API) refuse: ``try_cast('2026' as date)`` is 2026-01-01 and
``try_cast(' 42 ' as bigint)`` is 42. Every cast is therefore guarded by a shape
pattern first; text that does not have the shape gives NULL.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed shape patterns (must agree with the DuckDB oracle).
LONG_SHAPE = r"^[+-]?[0-9]+$"
# JSON numbers come out of Spark's map parser through a double, so large or
# small ones arrive in exponent form ("1.23456789E7"): the decimal shape
# accepts it.
DECIMAL_SHAPE = r"^[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
DOUBLE_SHAPE = r"^[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
BOOLEAN_SHAPE = r"^(true|false)$"
TIMESTAMP_Z_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?Z$"


def _guarded(text: Column, shape: str, type_name: str) -> Column:
    return F.when(text.rlike(shape), text.try_cast(type_name))


def to_long(text: Column) -> Column:
    return _guarded(text, LONG_SHAPE, "bigint")


def to_int(text: Column) -> Column:
    return _guarded(text, LONG_SHAPE, "int")


def to_decimal(text: Column, precision: int = 10, scale: int = 2) -> Column:
    return _guarded(text, DECIMAL_SHAPE, f"decimal({precision},{scale})")


def to_double(text: Column) -> Column:
    return _guarded(text, DOUBLE_SHAPE, "double")


def to_date(text: Column) -> Column:
    return _guarded(text, DATE_SHAPE, "date")


def to_timestamp_ntz(text: Column) -> Column:
    return _guarded(text, TIMESTAMP_SHAPE, "timestamp_ntz")


def to_timestamp_any(text: Column) -> Column:
    """One normaliser for the three client forms of a row time:

    * ISO text without zone (``2024-01-01T00:00:07.179575``), taken as UTC;
    * ISO text in UTC with ``Z`` (``2024-01-01T00:00:07.179Z``);
    * epoch seconds as a number (``1704067207.179575``, also in the exponent
      form Spark's JSON map parser gives doubles, ``1.704067207179575E9``),
      rounded to the microsecond through an exact decimal.

    The result is TIMESTAMP_NTZ (UTC wall clock) and does not depend on the
    session time zone.
    """
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    micros = F.round(text.try_cast("decimal(30,9)") * F.lit(1000000)).cast("long")
    return F.coalesce(
        to_timestamp_ntz(text),
        F.when(text.rlike(TIMESTAMP_Z_SHAPE),
               F.regexp_replace(text, "Z$", "").try_cast("timestamp_ntz")),
        F.when(text.rlike(DOUBLE_SHAPE), F.timestamp_add("MICROSECOND", micros, epoch)),
    )


def to_boolean(text: Column) -> Column:
    return _guarded(F.lower(text), BOOLEAN_SHAPE, "boolean")


def fits(v: Column, t: T.DataType) -> Column:
    """Whether every value inside a VARIANT can be cast (strictly) to its place in a nested
    type. Missing fields and JSON nulls fit; further fields are not looked at. The lambdas
    bind each node once, so the expression grows with the type and no faster."""
    def inside(x: Column) -> Column:
        if isinstance(t, T.StructType):
            m = x.try_cast("map<string,variant>")
            each = lambda y: F.expr("true") if not t.fields else functools.reduce(
                lambda a, b: a & b, [fits(F.try_element_at(y, F.lit(f.name)), f.dataType) for f in t.fields])
            return m.isNotNull() & F.forall(F.array(m), each)
        if isinstance(t, T.ArrayType):
            items = x.try_cast("array<variant>")
            return items.isNotNull() & F.forall(items, lambda y: fits(y, t.elementType))
        return cast_text(x.try_cast("string"), t.simpleString()).isNotNull()
    return F.forall(F.array(v), lambda x: x.isNull() | F.coalesce(F.is_variant_null(x), F.lit(False)) | F.coalesce(inside(x), F.lit(False)))


def cast_text(text: Column, type_name: str) -> Column:
    """Strict cast of JSON-extracted text to a declared SQL type name."""
    t = type_name.strip().lower()
    if t in ("bigint", "long", "integer", "number", "int"):
        return to_long(text) if t != "int" else to_int(text)
    if t.startswith("decimal") or t.startswith("number("):
        inner = t[t.index("(") + 1:t.index(")")]
        p, s = (int(x) for x in inner.split(","))
        return to_decimal(text, p, s)
    if t in ("double", "float"):
        return to_double(text)
    if t == "date":
        return to_date(text)
    if t in ("timestamp", "timestamp_ntz"):
        return to_timestamp_ntz(text)
    if t == "timestamp_auto":
        return to_timestamp_any(text)
    if t == "boolean":
        return to_boolean(text)
    if t in ("string", "varchar", "text") or t.startswith("varchar"):
        return text
    if t.startswith(("struct<", "array<")):
        v = F.try_parse_json(text)
        return F.when(fits(v, T._parse_datatype_string(type_name)), F.try_variant_get(v, "$", type_name))
    raise ValueError(f"unsupported declared type {type_name!r}")


def token_to_long(token: Column) -> Column:
    """Offset tokens are opaque text; numeric by convention. A token that is not
    a plain integer (or is NULL) has no numeric value."""
    return to_long(token)
