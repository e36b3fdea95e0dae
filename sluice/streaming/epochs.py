"""Tables of state kept by epoch, and the few file operations they need.

Every table writes one complete copy per epoch to ``epoch=N`` (its ``_SUCCESS`` mark
makes it count). An epoch that is replayed after a failure starts from the same earlier
copy and replaces its own, so the state follows the checkpointed source exactly.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


class Files:
    """File operations through Hadoop, so any shared store works."""

    def __init__(self, spark: SparkSession):
        self._sc = spark.sparkContext

    def _path(self, path: str):
        return self._sc._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._sc._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names inside a folder; none if there is no such folder."""
        fs = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(self._path(path))) if fs.exists(self._path(path)) else []

    def size(self, path: str) -> int:
        return self._fs(path).getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write a new small file in one step: readers see all of it or nothing. A file
        that is there already is never replaced."""
        part = path.rsplit("/", 1)[0] + "/_writing-" + path.rsplit("/", 1)[1]
        fs = self._fs(path)
        out = fs.create(self._path(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if fs.exists(self._path(path)) or not fs.rename(self._path(part), self._path(path)):
            raise FileExistsError(path)


class EpochTable:
    """One table of state, a complete copy per epoch."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema, self.files = spark, path.rstrip("/"), schema, Files(spark)

    def epochs(self) -> list[int]:
        found = [int(m[1]) for m in (re.fullmatch(r"epoch=(\d+)", n) for n in self.files.names(self.path)) if m]
        return sorted(e for e in found if self.files.exists(f"{self.path}/epoch={e}/_SUCCESS"))

    def at(self, *epochs: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/epoch={e}" for e in epochs])

    def before(self, epoch: int) -> DataFrame | None:
        """The copy that ``epoch`` starts from; None if there is none yet."""
        earlier = [e for e in self.epochs() if e < epoch]
        return self.at(earlier[-1]) if earlier else None

    def last(self) -> DataFrame:
        """The newest copy; an empty table while there is none."""
        found = self.epochs()
        return self.at(found[-1]) if found else self.spark.createDataFrame([], self.schema)

    def write(self, epoch: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")

    def trim(self, keep: set[int], epoch: int) -> None:
        """Remove copies older than ``epoch`` that are not in ``keep``."""
        for e in self.epochs():
            if e < epoch and e not in keep:
                self.files.delete(f"{self.path}/epoch={e}")
