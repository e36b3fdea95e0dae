"""Inference and evolution of nested payload fields, by path.

A payload is walked as VARIANT: objects as maps, arrays as lists. Every node below the
root has a path (``meta.tags[]``) and a mask with one bit for each shape its values may
have. Masks are combined with AND and counts are added, so summaries of batches or epochs
merge to the summary of all rows (:func:`merge_paths`).

Defined cases: JSON nulls do not count; keys keep their case within objects (two keys of
one object that differ only by case make it text), top-level keys are lower-cased; values
of different shapes at one path (an object and a number) make it VARCHAR and its inner
paths are not used for the column; an empty object or array counts as one of its kind. An
object that has a key twice is read at its top level only, its values as text.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import casts
from sluice.functions.json_fields import parse_object

#: The bits of a mask, narrowest first: the type of a path is that of its lowest bit.
BITS = {"BIGINT": 1, "DECIMAL": 2, "BOOLEAN": 4, "DATE": 8, "TIMESTAMP": 16, "OBJECT": 32, "ARRAY": 64}
SPARK_TYPE = {"BIGINT": "bigint", "DECIMAL": "decimal(38,9)", "BOOLEAN": "boolean", "DATE": "date",
              "TIMESTAMP": "timestamp_ntz"}
ELEMENT, DEEPER = "[]", ""
_MAP, _LIST = "map<string,variant>", "array<variant>"


def _node(steps: Column, v: Column) -> Column:
    """A node, cast to its fields and its elements once (both NULL for a scalar)."""
    return F.struct(steps.alias("steps"), v.alias("v"), v.try_cast(_MAP).alias("fields"), v.try_cast(_LIST).alias("elements"))


def _children(node: Column) -> Column:
    """The nodes directly below one node; none below a scalar."""
    fields = F.transform(F.map_entries(node["fields"]), lambda e: _node(
        F.concat(node["steps"], F.array(F.concat(F.lit("."), e["key"]))), e["value"]))
    elements = F.transform(node["elements"], lambda x: _node(F.concat(node["steps"], F.array(F.lit(ELEMENT))), x))
    return F.coalesce(fields, elements, F.array())


def _read(node: Column) -> Column:
    """What the summary takes from a node."""
    is_object, is_list = node["fields"].isNotNull(), node["elements"].isNotNull()
    return F.struct(node["steps"].alias("steps"), F.when(~is_object & ~is_list, node["v"].try_cast("string")).alias("text"),
                    is_object.alias("is_object"), is_list.alias("is_list"))


def _deeper() -> Column:
    """Stands for nodes below the last level (the first step of a path begins with a dot)."""
    return F.struct(F.array(F.lit(DEEPER)).alias("steps"), F.lit("").alias("text"), F.lit(False).alias("is_object"),
                    F.lit(False).alias("is_list"))


def _walk(nodes: Column, depth: int) -> Column:
    """The nodes of ``depth`` levels as :func:`_read`; each lambda binds a node once."""
    def visit(node: Column, left: int) -> Column:
        if left == 1:
            return F.when(F.size(_children(node)) > 0, F.array(_read(node), _deeper())).otherwise(F.array(_read(node)))
        return F.concat(F.array(_read(node)), F.flatten(F.transform(_children(node), lambda x: visit(x, left - 1))))
    return F.flatten(F.transform(nodes, lambda x: visit(x, depth)))


def _nodes(df: DataFrame, value: str, depth: int) -> DataFrame:
    """One row per node of the first ``depth`` levels, read in one parse of a payload."""
    exact = F.try_parse_json(F.col(value)).try_cast(_MAP)
    as_text = F.transform_values(parse_object(F.col(value)), lambda k, v: v.cast("variant"))
    top = F.transform(F.map_entries(F.coalesce(exact, as_text)), lambda e: _node(
        F.array(F.concat(F.lit("."), e["key"])), e["value"]))
    return df.select(F.inline(_walk(top, depth)))


def _mask(text: Column, is_object: Column, is_list: Column) -> Column:
    bit = lambda cond, name: F.when(cond, F.lit(BITS[name])).otherwise(F.lit(0))
    scalar = (bit(text.rlike(casts.LONG_SHAPE), "BIGINT") + bit(text.rlike(casts.DECIMAL_SHAPE), "DECIMAL")
              + bit(text.rlike(casts.BOOLEAN_SHAPE), "BOOLEAN")
              + bit(text.rlike(casts.DATE_SHAPE) & casts.to_date(text).isNotNull(), "DATE")
              + bit(text.rlike(casts.TIMESTAMP_SHAPE) & casts.to_timestamp_ntz(text).isNotNull(), "TIMESTAMP"))
    return F.when(is_object, F.lit(BITS["OBJECT"])).when(is_list, F.lit(BITS["ARRAY"])).otherwise(scalar)


def path_summary(df: DataFrame, value: str = "value", depth: int | None = None) -> DataFrame:
    """``steps``, ``mask``, ``n_values`` of every path of the payloads: one scan and one
    grouped aggregate with partial sums. ``depth`` levels are walked (default: all; levels
    are doubled until nothing lies deeper, and the summary, one row a path, is kept)."""
    if depth:
        return _summary(df, value, depth).where(F.element_at("steps", 1) != DEEPER)
    depth = 4
    while True:
        s = _summary(df, value, depth).localCheckpoint()
        if s.where(F.element_at("steps", 1) == DEEPER).isEmpty():
            return s
        depth *= 2


def _summary(df: DataFrame, value: str, depth: int) -> DataFrame:
    read = _nodes(df, value, depth).where(F.col("is_object") | F.col("is_list") | F.col("text").isNotNull())
    return _grouped(read.select("steps", _mask(F.col("text"), F.col("is_object"), F.col("is_list")).alias("mask"),
                                F.lit(1).cast("long").alias("n_values")))


def _grouped(rows: DataFrame) -> DataFrame:
    first = F.lower(F.element_at("steps", 1))
    folded = F.concat(F.array(first), F.slice("steps", 2, F.greatest(F.size("steps"), F.lit(1))))
    return (rows.groupBy(folded.alias("steps"))
            .agg(F.bit_and("mask").alias("mask"), F.sum("n_values").alias("n_values")))


def merge_paths(*summaries: DataFrame) -> DataFrame:
    """The summary of all rows from the summaries of parts of them."""
    merged = summaries[0]
    for s in summaries[1:]:
        merged = merged.unionByName(s)
    return _grouped(merged)


def mask_type(mask: Column, dates_as_text: bool = False) -> Column:
    out = F.lit("VARCHAR")
    for name, bit in reversed(BITS.items()):
        shown = "VARCHAR" if dates_as_text and name in ("DATE", "TIMESTAMP") else name
        out = F.when(mask.bitwiseAND(F.lit(bit)) != 0, F.lit(shown)).otherwise(out)
    return out


def infer_paths(df: DataFrame, value: str = "value", dates_as_text: bool = False) -> DataFrame:
    """Every path with its inferred type and how many non-null values it has."""
    s = path_summary(df, value)
    path = F.regexp_replace(F.array_join("steps", ""), r"^\.", "")
    return s.select(path.alias("path"), mask_type(F.col("mask"), dates_as_text).alias("inferred_type"), "n_values")


# -- columns -----------------------------------------------------------------------

def _type_of(steps: tuple, found: dict, below: dict) -> T.DataType:
    kind = found.get(steps, "VARCHAR")
    if kind == "OBJECT":
        names = [s[-1][1:] for s in sorted(below.get(steps, ()))]
        if names and len({n.lower() for n in names}) == len(names):
            return T.StructType([T.StructField(n, _type_of((*steps, "." + n), found, below)) for n in names])
    if kind == "ARRAY":
        return T.ArrayType(_type_of((*steps, ELEMENT), found, below))
    return T._parse_datatype_string(SPARK_TYPE.get(kind, "string"))


def column_types(summary: DataFrame, max_paths: int = 10_000) -> dict[str, T.DataType]:
    """A type for each top-level key, structs and arrays where the paths have them. More
    than ``max_paths`` paths (ids used as keys) are refused, not cut."""
    rows = summary.select("steps", mask_type(F.col("mask")).alias("t")).limit(max_paths + 1).collect()
    if len(rows) > max_paths:
        raise ValueError(f"payloads have over {max_paths} paths")
    found = {tuple(r.steps): r.t for r in rows}
    below: dict[tuple, list] = {}
    for steps in found:
        below.setdefault(steps[:-1], []).append(steps)
    return {steps[0][1:]: _type_of(steps, found, below) for steps in sorted(below.get((), ()))}


def widened(old: T.DataType, new: T.DataType) -> T.DataType:
    """``old`` with the fields only ``new`` has, at every level. What ``old`` has keeps its
    type, so landed files stay readable; values that do not fit are error rows."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        by_name = {f.name.lower(): f for f in new.fields}
        kept = [T.StructField(f.name, widened(f.dataType, by_name[f.name.lower()].dataType))
                if f.name.lower() in by_name else f for f in old.fields]
        have = {f.name.lower() for f in old.fields}
        return T.StructType([*kept, *[f for f in new.fields if f.name.lower() not in have]])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType))
    return old


def ddl(t: T.DataType) -> str:
    """The type as SQL text, field names quoted."""
    if isinstance(t, T.StructType):
        return "struct<" + ",".join("`" + f.name.replace("`", "``") + "`:" + ddl(f.dataType) for f in t.fields) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{ddl(t.elementType)}>"
    return t.simpleString()
