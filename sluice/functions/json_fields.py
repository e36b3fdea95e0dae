"""Parsing JSON payloads and picking fields by name.

``from_json`` matches struct field names case-sensitively, while landing must
match declared columns case-insensitively. Payloads are therefore parsed to a
``map<string,string>`` once (the map keeps every entry in payload order,
repeated keys included), and a declared column takes the value of the *last*
key equal to its name ignoring case; a missing key and an explicit null both
give NULL. Nested values come out of the map as JSON text.

Landing uses the lambda-free form (:func:`lowered_key_list`,
:func:`position_of`, :func:`value_at`) so its projections stay in whole-stage
codegen; :func:`pick` is the same rule as a single expression, for ad-hoc use.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAYLOAD_MAP = "map<string,string>"


def parse_object(value: Column) -> Column:
    """JSON object text -> map<string,string>; NULL for anything that is not
    an object (text, broken JSON, empty, ``null``, arrays)."""
    return F.from_json(value, PAYLOAD_MAP)


def pick(m: Column, name: str) -> Column:
    """Value of the last key of ``m`` equal to ``name`` ignoring case."""
    lname = name.lower()
    hits = F.filter(F.map_entries(m), lambda e: F.lower(e["key"]) == F.lit(lname))
    return F.try_element_at(F.transform(hits, lambda e: e["value"]), F.lit(-1))


_SEP = "\u0000"


def lowered_key_list(m: Column) -> Column:
    """The keys of ``m``, lower-cased, in payload order.

    One ``array_join`` / ``lower`` / ``split`` (all codegen'd) instead of a
    lambda per key. A key that itself contains the separator (NUL) would
    break the split; the sizes then differ and the JSON round trip (exact for
    any key) is used instead.
    """
    fast = F.split(F.lower(F.array_join(F.map_keys(m), _SEP)), _SEP)
    exact = F.from_json(F.lower(F.to_json(F.map_keys(m))), "array<string>")
    return (F.when(F.size(m) == 0, F.array().cast("array<string>"))
            .when(F.size(fast) == F.size(m), fast)
            .otherwise(exact))


def position_of(reversed_keys: Column, name: str) -> Column:
    """1-based position of ``name`` in the *reversed* lower-cased key list
    (0 when absent): the first hit there is the last key in the payload."""
    return F.array_position(reversed_keys, F.lit(name.lower()))


def value_at(m: Column, n_keys: Column, pos: Column) -> Column:
    """The map value at payload position ``n_keys - pos + 1`` (NULL when
    ``pos`` is 0). Maps from ``from_json`` keep payload order."""
    return F.when(pos > 0, F.element_at(F.map_values(m), (n_keys - pos + 1).cast("int")))


def unknown_keys(m: Column, declared: list[str]) -> Column:
    """Keys of ``m`` that match no declared column (case-insensitively), in
    payload order."""
    known = F.array(*[F.lit(c.lower()) for c in declared])
    return F.filter(F.map_keys(m), lambda k: ~F.array_contains(known, F.lower(k)))
