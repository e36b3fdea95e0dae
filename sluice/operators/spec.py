"""Declared landing tables."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str                      # Spark SQL type name, e.g. "bigint", "decimal(10,2)"
    max_length: int | None = None  # VARCHAR(n)
    default: str | None = None     # "as_of" fills the landing time when missing
    comment: str | None = None

    @property
    def kind(self) -> str:
        t = self.type.lower()
        if t.startswith("decimal"):
            return "decimal"
        if t in ("bigint", "long", "int", "integer"):
            return "bigint"
        if t in ("timestamp", "timestamp_ntz", "timestamp_auto"):
            return "timestamp"
        if t.startswith(("struct<", "array<")):
            return t[:t.index("<")]
        return t


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    evolve: bool = False           # ENABLE_SCHEMA_EVOLUTION
    nested: bool = False           # new objects and arrays become structs and arrays, not text
    comment: str | None = None
    extra_columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self) -> T.StructType:
        fields = []
        for c in self.columns + self.extra_columns:
            meta = {"comment": c.comment} if c.comment else {}
            t = "timestamp_ntz" if c.type == "timestamp_auto" else c.type
            fields.append(T.StructField(c.name, T._parse_datatype_string(t), True, meta))
        return T.StructType(fields)

    @staticmethod
    def from_tuples(name: str, cols, **kw) -> "TableSpec":
        return TableSpec(name, tuple(ColumnSpec(n, t, m) for n, t, m in cols), **kw)
