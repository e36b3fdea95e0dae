"""Pipes and record shaping: user-defined SELECT over the payload, JSON path
access, filters, masking, record metadata, routing and naming rules."""
from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.masking import mask_column

VARIANT = "__variant"


# -- P3 / P4 / P5 --------------------------------------------------------------

@dataclass(frozen=True)
class PipeField:
    """``$1:<path>::<type> AS <alias>``; ``path`` is a VARIANT path such as
    ``$.a``, ``$['f n']``, ``$.p.c`` or ``$.p['c d']``; a ``meta:<column>``
    path reads a record column instead (topic, offset, ...)."""
    path: str
    type: str
    alias: str


def pipe_transform(df: DataFrame, fields: Sequence[PipeField], where: str | Column | None = None,
                   value: str = "value") -> DataFrame:
    """A user-defined pipe: one ``select`` of typed path extractions (with
    renames and casts), then the pipe's filter."""
    d = df.withColumn(VARIANT, F.try_parse_json(F.col(value)))
    cols = []
    for f in fields:
        if f.path.startswith("meta:"):
            cols.append(F.col(f.path[5:]).cast(f.type).alias(f.alias))
        else:
            cols.append(F.try_variant_get(F.col(VARIANT), f.path, f.type).alias(f.alias))
    out = d.select(*cols)
    if where is not None:
        out = out.where(where if isinstance(where, Column) else F.expr(where))
    return out


# -- P6 -------------------------------------------------------------------------

def mask_columns(df: DataFrame, policies: dict[str, str]) -> DataFrame:
    """Replace each listed column by its masked form."""
    return df.select(*[mask_column(F.col(c), policies[c]).alias(c) if c in policies else F.col(c)
                       for c in df.columns])


# -- P7 / P8 / P9 ---------------------------------------------------------------

METADATA_FIELDS = ("topic", "partition", "offset", "CreateTime", "ConnectorPushTime",
                   "key", "headers")


def record_metadata(all_fields: bool = True, topic: bool = True, offset_and_partition: bool = True,
                    create_time: str = "timestamp", push_time: str = "push_time",
                    headers: str | None = None) -> Column | None:
    """The record metadata struct. ``partition`` is text; times are epoch ms.
    The switches drop fields the way the connector options do; with
    ``all_fields=False`` there is no metadata column at all."""
    if not all_fields:
        return None
    fields = []
    if topic:
        fields.append(F.col("topic").alias("topic"))
    if offset_and_partition:
        fields.append(F.col("partition").cast("string").alias("partition"))
        fields.append(F.col("offset").alias("offset"))
    fields.append(F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                                   F.col(create_time)).alias("CreateTime"))
    fields.append(F.col(push_time).alias("ConnectorPushTime"))
    fields.append(F.col("key").alias("key"))
    if headers is not None:
        fields.append(F.col(headers).alias("headers"))
    return F.struct(*fields)


def with_record_metadata(df: DataFrame, **switches) -> DataFrame:
    meta = record_metadata(**switches)
    return df if meta is None else df.withColumn("record_metadata", meta)


def two_variant_layout(df: DataFrame, value: str = "value", **switches) -> DataFrame:
    """Not schematized: RECORD_CONTENT (VARIANT of the payload) and
    RECORD_METADATA."""
    cols = [F.try_parse_json(F.col(value)).alias("record_content")]
    meta = record_metadata(**switches)
    if meta is not None:
        cols.append(meta.alias("record_metadata"))
    return df.select(*cols)


# -- P10 / P11 / K3 -----------------------------------------------------------

def parse_topic_map(option: str) -> list[tuple[str, str]]:
    """``topic2table.map``: ``a:T1,b:T2``, regex keys (``.*_events:ALL``) and
    quoted names (``"my:topic":"My_Table"``). Parsed once on the driver."""
    out = []
    token = re.compile(r'\s*("(?:[^"]|"")*"|[^:,]+)\s*:\s*("(?:[^"]|"")*"|[^,]+)\s*(?:,|$)')
    pos = 0
    option = option.strip()
    while pos < len(option):
        m = token.match(option, pos)
        if not m:
            raise ValueError(f"bad topic2table.map near {option[pos:]!r}")
        src, dst = (x.strip() for x in m.groups())
        if src.startswith('"'):
            src = src[1:-1].replace('""', '"')
        if dst.startswith('"'):
            dst = dst[1:-1].replace('""', '"')
        out.append((src, dst))
        pos = m.end()
    return out


#: A dot is common in topic names, so a name whose only special character is a
#: dot is taken literally.
_REGEX_CHARS = set("*+?[](){}|^$\\")


def sanitize_table_name(topic: Column) -> Column:
    """Upper case, every character outside [A-Za-z0-9_] replaced by '_'."""
    return F.upper(F.regexp_replace(topic, "[^A-Za-z0-9_]", "_"))


def route_topics(topic: Column, mapping: str | Sequence[tuple[str, str]],
                 sanitize: bool = True) -> Column:
    """Target table of each record: an explicit entry first, then the first
    regex entry that matches the whole topic, otherwise the topic's own name
    (sanitised unless ``sanitize`` is off)."""
    pairs = parse_topic_map(mapping) if isinstance(mapping, str) else list(mapping)
    explicit = [(s, d) for s, d in pairs if not (set(s) & _REGEX_CHARS)]
    regexes = [(s, d) for s, d in pairs if set(s) & _REGEX_CHARS]
    default = sanitize_table_name(topic) if sanitize else topic
    expr = None
    for s, d in explicit + [(f"^(?:{s})$", d) for s, d in regexes]:
        cond = (topic == F.lit(s)) if not s.startswith("^(?:") else topic.rlike(s)
        expr = F.when(cond, F.lit(d)) if expr is None else expr.when(cond, F.lit(d))
    return default if expr is None else expr.otherwise(default)


def channel_name(prefix: Column | str, partition: Column) -> Column:
    """One channel per log partition: ``<prefix>_P<partition>``."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(p, F.lit("_P"), partition.cast("string"))


# -- P12 / P17 -------------------------------------------------------------------

def normalize_identifiers(df: DataFrame, upper: bool = True) -> DataFrame:
    """Upper-case column identifiers (or keep them); two columns that become
    the same name are an error rather than a silent overwrite."""
    if not upper:
        return df
    new = [c.upper() for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after upper-casing: {df.columns}")
    return df.toDF(*new)


def session_context(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.current_user().alias("current_user"),
                                 F.current_catalog().alias("current_catalog"),
                                 F.current_database().alias("current_database"))
