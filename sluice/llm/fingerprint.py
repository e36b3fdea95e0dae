"""Document fingerprints by a threshold-scaled sketch, with DataFrame functions only.

A sketch keeps every shingle hash (five words, A-Z lower-cased; a shorter text is
one shingle) below a fixed fraction of the hash range, and the smallest hash alone
if none is below. The size follows the document, so containment between very
unequal documents can be estimated, and sketches merge: the union of two sketches,
thinned by the same rule, is the sketch of the two documents together.

``next`` documents are found by blocks of ``BLOCK`` consecutive ids: one shuffle
deals the texts out by block, and the first row of a block is also put after the
last row of the block before it. Sketches are made after that shuffle, so only texts
are moved.

Defined cases: a null text is empty; a text without words has an empty sketch
(likeness 1 to another empty one, 0 to others); equal ids follow each other by
text; rows with a null id have no next document; the last document's next is the
first, so a lone document is its own next; an empty table gives no rows. Extra
columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, documents, small_side, text_or_empty, words, written

#: Share of the hash range that is kept: 1 / SCALE; QUERY_SCALE in the query, as
#: ordinary documents are short.
SCALE = 16
QUERY_SCALE = 2
SHINGLE = 5
BLOCK = 256


def limit_of(scale: int) -> int:
    """Signed 64-bit hashes below this are kept."""
    return -2**63 + 2**64 // scale


def sketched(df: DataFrame, text: str, out: str, scale: int = SCALE) -> DataFrame:
    """Adds the sorted sketch of column ``text`` as ``out``."""
    kept = [c for c in df.columns]
    a = df.select(*kept, words(ascii_lower(F.col(text))).alias("__w"))
    each = F.transform(F.sequence(F.lit(0), F.size("__w") - SHINGLE), lambda i: F.xxhash64(*[F.get("__w", i + j) for j in range(SHINGLE)]))
    b = a.select(*kept, F.when(F.size("__w") == 0, F.array().cast("array<bigint>"))
                 .when(F.size("__w") < SHINGLE, F.array(F.xxhash64("__w"))).otherwise(each).alias("__h"))
    c = b.select(*kept, F.filter("__h", lambda h: h < limit_of(scale)).alias("__k"), F.array_min("__h").alias("__m"))
    return c.select(*kept, F.when(F.size("__k") > 0, F.sort_array(F.array_distinct("__k")))
                    .otherwise(F.array_compact(F.array("__m"))).alias(out))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of two documents taken together."""
    both = F.array_union(a, b)
    low = F.filter(both, lambda h: h < limit_of(scale))
    return F.when(F.size(low) > 0, F.sort_array(low)).otherwise(F.slice(F.sort_array(both), 1, 1))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two sketches."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def previous_blocks(ids: DataFrame) -> tuple[DataFrame, int]:
    """For every block of ids its first id (``first``) and the block before it
    (``before``; the first block's is the last). Neighbours are found in blocks of
    blocks, so no window holds more than a small share of the table."""
    b = written(ids.filter(F.col("doc_id").isNotNull()).groupBy(F.floor(F.col("doc_id") / BLOCK).alias("block"))
                .agg(F.min("doc_id").alias("first")), "ids")
    top = F.floor(F.col("block") / BLOCK).alias("top")
    ends = b.groupBy(top).agg(F.max("block").alias("last"))
    order = Window.orderBy("top")  # one row for every BLOCK * BLOCK ids
    ends = ends.select("top", F.lag("last").over(order).alias("carry"))
    last, n = b.agg(F.max("block"), F.count(F.lit(1))).first()
    inner = Window.partitionBy("top").orderBy("block")
    out = b.select("first", "block", top).withColumn("in", F.lag("block").over(inner)).join(ends, "top")
    return out.select("first", F.coalesce("in", "carry", F.lit(last)).cast("long").alias("before")), n


def with_next(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Adds ``next``: a struct of ``cols`` of the next row by doc_id."""
    before, n = previous_blocks(rows.select("doc_id"))
    # repeated first ids: the copy that stands first goes ahead of the others
    own = F.coalesce(F.floor(F.col("doc_id") / BLOCK), F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
    j = rows.join(small_side(before, n), F.col("doc_id") == F.col("first"), "left")
    dealt = j.withColumn("at", F.explode(F.array_compact(F.array(
        F.struct(own.alias("block"), F.lit(0).alias("guest")),
        F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("block"), F.lit(1).alias("guest")))))))
    w = Window.partitionBy(F.col("at")["block"], F.col("doc_id").isNull()).orderBy(F.col("at")["guest"], "doc_id", "text")
    out = dealt.withColumn("next", F.lead(F.struct(*cols)).over(w)).filter(F.col("at")["guest"] == 0)
    return out.withColumn("next", F.when(F.col("doc_id").isNotNull(), F.col("next"))).drop("first", "before", "at")


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Per document: its sketch, its edited text's, the next document's."""
    n = with_next(docs.select("doc_id", text_or_empty().alias("text")), ["text"])
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - quarter),
                      F.substring(F.coalesce(F.col("next")["text"], F.lit("")), F.lit(1), quarter))
    e = n.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text", F.col("next")["text"].alias("next_text"),
                 edited.alias("edited"))
    s = sketched(sketched(sketched(e, "text", "sketch", scale).drop("text"), "edited", "edited_sketch", scale), "next_text", "next_sketch", scale)
    return s.withColumn("next_sketch", F.when(F.col("next_text").isNotNull(), F.col("next_sketch"))).drop("next_text")


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fingerprints(documents(spark, sf_dir), QUERY_SCALE)
    empty = F.array().cast("array<bigint>")
    nxt = F.coalesce("next_sketch", empty)
    return f.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"), likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), nxt).alias("near_next"), containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_in_own"))
