"""Corpus pipeline: quality rules, line de-dup, one document of each near-duplicate
group, secret masking, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns
of ``documents``.

Defined cases: a null text counts as empty (the quality rules reject it; the other stages
keep it as null); null and repeated ids are rows like others; an empty table goes through
as one; further columns, whatever their names, are carried along unchanged (the last
stage ignores them).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import jaccard, lines, packing, quality, secrets
from sluice.llm.common import SPACE, boxed, documents, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    docs, back = boxed(docs)
    dropped = quality.judge(docs, with_hash=True).filter(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("host").alias("__host"), F.col("text_hash").alias("__hash"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__host")) & quality.text_hash().eqNullSafe(F.col("__hash"))
    return back(docs.join(dropped, same, "left_anti"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later repeated runs of lines; a document left without text goes."""
    docs, back = boxed(docs)
    got = lines.delete_repeats(docs)
    left = (F.col("__n_deleted") == 0) | (F.btrim("text", F.lit(SPACE)) != "")
    return back(got.filter(left).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id, null last.
    The groups are those of numbered rows, as ids can be null or repeated."""
    docs, back = boxed(docs)
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "near-rows")
    found = jaccard.jaccard_components(rows.select(F.col("__row").alias("doc_id"), "text"))
    others = written(found.filter(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("__row"), F.col("component_id").alias("group")), "near-groups")
    members = others.union(others.select(F.col("group").alias("__row"), "group").distinct())
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__row")
    stay = members.join(rows.select("__row", "doc_id"), "__row").groupBy("group").agg(F.min(order).alias("first")).select(F.col("first")["__row"].alias("__row"))
    gone = members.select("__row").join(stay, "__row", "left_anti")
    return back(rows.join(gone, "__row", "left_anti"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret in the texts."""
    docs, back = boxed(docs)
    got = secrets.scan(docs)
    text = F.when(F.size("__spans") > 0, secrets.mask(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))
    return back(got.withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents left into token sequences."""
    return packing.packed(docs, special=True)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("secret_scans", secret_scans),
          ("best_fit_packing", best_fit_packing)]

#: The n-gram join and the packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
