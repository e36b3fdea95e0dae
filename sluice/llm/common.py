"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import checkpoint_path

#: White space that separates words: space, tab, LF, VT, FF, CR.
SPACE = "\x20\x09\x0A\x0B\x0C\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows up to which a narrow side (a few numbers a row) may be broadcast; a
#: larger side is joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the cluster's shared checkpoint folder and read it back:
    later steps start from the files, so a lost executor costs no recomputation
    of what came before."""
    spark = df.sparkSession
    path = checkpoint_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a narrow side of ``rows`` counted rows, if within the
    bound; otherwise the side is left for a shuffle join."""
    return F.broadcast(df) if rows <= bound else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def boxed(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but those of ``documents`` in one struct, so that no name
    of theirs meets a step's own columns, and the function that gives a result of such
    steps the columns of ``docs`` again, in their order."""
    own = [c for c in docs.columns if c in ("doc_id", "text", "lang", "source", "n_chars")]
    rest = [c for c in docs.columns if c not in own]
    name = lambda c: f"`{c.replace('`', '``')}`"
    box = [F.struct(*[F.col(name(c)).alias(f"c{k}") for k, c in enumerate(rest)]).alias("box")] if rest else []

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in own else F.col(f"box.c{rest.index(c)}").alias(c) for c in docs.columns])

    return docs.select(*own, *box), back


def spread(spark: SparkSession) -> int:
    """Number of partitions that shuffles of this session use."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Give the executors' Python workers this library (once per application), so that
    operators with Python code run wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(package)))
    sc.addPyFile(name)


def literal_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A small fixed table, made in the JVM (no Python workers)."""
    one = [F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*one)))
