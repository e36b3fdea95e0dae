"""A landed table with a manifest: old epochs are compacted, readers never notice.

Landing writes one ``_epoch`` folder per micro-batch. Compaction merges settled epochs
into parts, sorted by (topic, partition, offset), and publishes a new manifest version:
the parts with their epochs and the offset range of each log partition, and the epoch
``through`` which all are in parts. A reader takes the newest manifest, its parts and the
epoch folders beyond ``through``. Nothing that a manifest names is changed or removed
when a newer one is published; ``vacuum`` removes what the newest ``keep`` versions do
not need.

* The newest epoch is never compacted, since a restart may replay it; a replay of a
  compacted epoch adds nothing.
* Parts are merged in tiers: ``fan`` parts of a tier become one of the next, so there
  are at most ``fan`` times log(epochs) parts and a row is rewritten log(epochs) times.
* A manifest is published by renaming a complete file to a name that must be new: of two
  compactions at the same time one fails and leaves the table as it was.

Defined cases: a table without epochs reads as None; columns that an epoch lacks are
NULL; rows with NULL topic, partition or offset are kept and stand in no range.
"""
from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.nested import widened
from sluice.streaming.epochs import Files

#: Bytes of one file of a part, at most, and about the bytes of rows that one task sorts:
#: files of repetitive rows are far smaller than the rows.
FILE_BYTES, SORT_BYTES = 256 << 20, 128 << 20
KEYS = ("topic", "partition", "offset")


def _row_bytes(rows: DataFrame) -> Column:
    """About the bytes of a row in memory: a word a column, and what has no fixed width."""
    wide = []
    for f in rows.schema:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide.append(F.octet_length(c))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            wide.append(F.octet_length(c.cast("string")))
    words = F.lit(8 * (len(rows.columns) + 3)).cast("long")
    return reduce(lambda a, b: a + F.coalesce(b, F.lit(0)), wide, words)


class LandedTable:
    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target, self.files = spark, target.rstrip("/"), Files(spark)
        self.manifests, self.parts = self.target + "-manifest", self.target + "-parts"

    # -- manifest ------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(m[1]) for m in (re.fullmatch(r"v(\d+)\.json", n) for n in self.files.names(self.manifests)) if m)

    def manifest(self, version: int | None = None) -> dict:
        """A manifest (default: the newest); an empty one while none is published."""
        if version is None:
            found = self.versions()
            if not found:
                return {"version": 0, "through": -1, "parts": []}
            version = found[-1]
        return json.loads(self.files.read_text(f"{self.manifests}/v{version:09d}.json"))

    def epochs(self) -> list[int]:
        """Epoch folders, compacted or not."""
        return sorted(int(m[1]) for m in (re.fullmatch(r"_epoch=(\d+)", n) for n in self.files.names(self.target)) if m)

    # -- reading -------------------------------------------------------------------

    def _read(self, parts: list[str], epochs: list[int]) -> DataFrame | None:
        def frames(schema=None):
            merged = self.spark.read.option("mergeSchema", "true") if schema is None else self.spark.read.schema(schema)
            if parts:
                yield merged.parquet(*[f"{self.parts}/{p}" for p in parts])
            if epochs:
                one = merged.option("basePath", self.target).parquet(*[f"{self.target}/_epoch={e}" for e in epochs])
                yield one.withColumn("_epoch", F.col("_epoch").cast("long"))

        found = list(frames())
        if len(found) < 2:
            return found[0] if found else None
        parts_have, epochs_have = ({f.name: f.dataType for f in d.schema} for d in found)
        if any(epochs_have.get(n, t) != t for n, t in parts_have.items()):   # newer fields inside a column
            found = list(frames(widened(found[0].schema, found[1].schema)))
        return found[0].unionByName(found[1], allowMissingColumns=True)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The whole table with ``_epoch``, as of a manifest; None while it is empty."""
        m = self.manifest(version)
        return self._read([p["path"] for p in m["parts"]], [e for e in self.epochs() if e > m["through"]])

    def read_offsets(self, topic: str, partition: int, low: int, high: int) -> DataFrame | None:
        """The rows of a log partition with offsets from ``low`` to ``high``: parts whose
        range does not meet them are not opened."""
        m = self.manifest()
        parts = [p["path"] for p in m["parts"]
                 if any(t == topic and q == partition and lo <= high and hi >= low for t, q, lo, hi in p["ranges"])]
        got = self._read(parts, [e for e in self.epochs() if e > m["through"]])
        if got is None:
            return None
        return got.where((F.col("topic") == topic) & (F.col("partition") == partition) & F.col("offset").between(low, high))

    # -- compaction ----------------------------------------------------------------

    def _write_part(self, rows: DataFrame, size: int, tier: int, first: int, last: int, file_bytes: int) -> dict:
        path = uuid.uuid4().hex
        order = [k for k in KEYS if k in rows.columns] or rows.columns[:1]
        in_memory = rows.agg(F.sum(_row_bytes(rows)).alias("n")).first().n or 0
        (rows.repartitionByRange(max(1, -(-size // file_bytes), -(-in_memory // SORT_BYTES)), *order).sortWithinPartitions(*order)
         .write.parquet(f"{self.parts}/{path}"))
        written = self.spark.read.parquet(f"{self.parts}/{path}")
        ranges = []
        if set(KEYS) <= set(rows.columns):  # one row per log partition
            ranges = [[r.topic, r.partition, r.lo, r.hi] for r in
                      written.where("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL")
                      .groupBy("topic", "partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
                      .orderBy("topic", "partition").collect()]
        return {"path": path, "tier": tier, "first": first, "last": last, "rows": written.count(), "ranges": ranges}

    def compact(self, through: int | None = None, fan: int = 8, file_bytes: int = FILE_BYTES) -> dict:
        """Merge settled epochs (up to ``through``; never the newest) into parts and
        publish the manifest. Returns the manifest that is valid then."""
        if fan < 2:
            raise ValueError("fan must be at least 2")
        m = self.manifest()
        epochs = self.epochs()
        fresh = [e for e in epochs[:-1] if e > m["through"] and (through is None or e <= through)]
        if not fresh:
            return m
        size = sum(self.files.size(f"{self.target}/_epoch={e}") for e in fresh)
        parts = [*m["parts"], self._write_part(self._read([], fresh), size, 0, fresh[0], fresh[-1], file_bytes)]
        tier = 0
        while len(same := [p for p in parts if p["tier"] == tier]) >= fan:
            size = sum(self.files.size(f"{self.parts}/{p['path']}") for p in same)
            one = self._write_part(self._read([p["path"] for p in same], []), size, tier + 1,
                                   min(p["first"] for p in same), max(p["last"] for p in same), file_bytes)
            parts = [one if p is same[0] else p for p in parts if p is same[0] or p not in same]
            tier += 1
        new = {"version": m["version"] + 1, "through": fresh[-1], "parts": parts}
        self.files.publish(f"{self.manifests}/v{new['version']:09d}.json", json.dumps(new))
        return new

    def vacuum(self, keep: int = 2) -> None:
        """Remove epoch folders and parts that none of the newest ``keep`` manifests reads.
        Readers of an older manifest must be done. A part that a running compaction has
        not published yet is unknown to all manifests: do not run both at once."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        versions = self.versions()
        held = [self.manifest(v) for v in versions[-keep:]]
        if not held:
            return
        for v in versions[:-keep]:
            self.files.delete(f"{self.manifests}/v{v:09d}.json")
        needed = {p["path"] for m in held for p in m["parts"]}
        for name in self.files.names(self.parts):
            if name not in needed:
                self.files.delete(f"{self.parts}/{name}")
        for e in self.epochs():
            if e <= min(m["through"] for m in held):
                self.files.delete(f"{self.target}/_epoch={e}")
