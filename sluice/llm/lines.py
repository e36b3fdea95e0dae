"""Line de-duplication by winnowing over line hashes, with DataFrame functions only.

A run is a stretch of consecutive non-blank lines. Every later occurrence of a run
with at least ``min_words`` words is deleted; the first one (by document id, then
place) stays, so every deleted line still stands in an earlier place.

Windows are the shortest runs of ``min_words`` words, read forwards from each line
and backwards from each line (at most ``min_words`` lines). From each window the
line with the smallest hash is selected: equal windows select equal lines, so a
repeated run always shares a selected fingerprint. Windows whose fingerprint stands
at one place only are dropped; the others are compared by a digest of their whole
text. Forward windows carry a match on to the right and backward windows to the
left, so the union of a document's matched windows is the whole repeated run.

Defined cases: a null text stays null; blank lines never match and go only inside a
deleted run; rows with the same id and text are one document; a null id comes
first; within a document, overlapping repeats collapse onto the first; an empty
table gives no rows. ``repeated_runs`` reads only the id and text columns.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, text_or_empty, written

MIN_WORDS = 50
BREAK = "\n"


def _windows(min_words: int, backward: bool) -> Column:
    """Windows over the array ``__l`` of (i, h, w, s): line number, hash, words, text."""
    def shortest(k: Column) -> Column:
        part = F.reverse(F.slice("__l", F.greatest(k - min_words + 2, F.lit(1)), F.least(k + 1, F.lit(min_words)))) \
            if backward else F.slice("__l", k + 1, min_words)
        return F.aggregate(part, F.struct(F.lit(0).alias("w"), F.lit(0).alias("n")), lambda a, x: F.when(
            a["w"] < min_words, F.struct((a["w"] + x["w"]).alias("w"), (a["n"] + 1).alias("n"))).otherwise(a))

    def window(k: Column) -> Column:
        s = shortest(k)
        return F.when(s["w"] >= min_words, F.struct((k - s["n"] + 1 if backward else k).alias("p"), s["n"].alias("n")))

    return F.array_compact(F.transform(F.sequence(F.lit(0), F.size("__l") - 1), window))


def windows(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, th (text hash), kind, start and end line, fp (selected line's hash),
    fresh (first window to select that place), key (digest of the window)."""
    split = F.split("__t", BREAK)
    lines = F.filter(F.transform(split, lambda s, i: F.struct(
        i.alias("i"), F.xxhash64(s).alias("h"), F.regexp_count(s, F.lit(r"[^\x20\x09-\x0D]+")).alias("w"), s.alias("s"))),
        lambda x: x["w"] > 0)
    a = docs.select(F.col("doc_id"), text_or_empty().alias("__t")) \
        .select("doc_id", F.xxhash64("__t").alias("th"), lines.alias("__l"))
    some = F.size("__l") > 0
    a = a.select("doc_id", "th", "__l", F.when(some, _windows(min_words, False)).alias("f"),
                 F.when(some, _windows(min_words, True)).alias("b"))

    def described(col: str, kind: int) -> Column:
        def one(x: Column) -> Column:
            part = F.slice("__l", x["p"] + 1, x["n"])
            least = F.array_min(F.transform(part, lambda y: F.struct(y["h"].alias("h"), (-y["i"]).alias("i"))))
            return F.struct(F.lit(kind).alias("kind"), F.get("__l", x["p"])["i"].alias("start"),
                            F.get("__l", x["p"] + x["n"] - 1)["i"].alias("end"), least.alias("least"),
                            F.unhex(F.md5(F.array_join(F.transform(part, lambda y: y["s"]), BREAK))).alias("key"))
        return F.transform(col, one)

    b = a.select("doc_id", "th", described("f", 0).alias("f"), described("b", 1).alias("b"))
    fresh = lambda c: F.transform(c, lambda x, i: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["least"]["h"].alias("fp"),
        (F.coalesce(F.get(c, i - 1)["least"]["i"], F.lit(1)) != x["least"]["i"]).cast("int").alias("fresh"),
        x["key"].alias("key")))
    return b.select("doc_id", "th", F.inline(F.concat(fresh("f"), fresh("b"))))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th and ``runs``: disjoint (start, end) line ranges that repeat an
    earlier place; only documents that have any."""
    w = written(windows(docs, min_words), "line-windows")
    prints = w.groupBy("kind", "fp").agg(F.sum("fresh").alias("n")).filter("n > 1").select("kind", "fp")
    met = w.join(prints, ["kind", "fp"], "left_semi")
    place = F.struct("doc_id", "th", "start")
    first = met.groupBy("kind", "key").agg(F.min(place).alias("first"), F.max(place).alias("last")) \
        .filter(~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    later = met.join(first, ["kind", "key"]).filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "th", "start", "end")
    before = Window.partitionBy("doc_id", "th").orderBy("start", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    runs = later.withColumn("new", F.coalesce(F.col("start") > reach + 1, F.lit(True)).cast("int")) \
        .withColumn("run", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "th", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")) \
        .groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))


def delete_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with the text cut, and ``__runs`` (null: none),
    ``__n_lines`` and ``__n_deleted``."""
    runs = repeated_runs(docs, min_words).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"),
                                                 F.col("runs").alias("__runs"))
    d = docs.withColumn("__at", F.xxhash64(text_or_empty()))
    got = d.join(runs, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__at") == F.col("__th")), "left") \
        .withColumn("__lines", F.split("text", BREAK))
    kept = F.filter("__lines", lambda s, i: ~F.exists("__runs", lambda r: (i >= r["start"]) & (i <= r["end"])))
    deleted = F.aggregate("__runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"] + 1)
    return got.withColumns({
        "text": F.when(F.col("__runs").isNull(), F.col("text")).otherwise(F.array_join(kept, BREAK)),
        "__n_lines": F.coalesce(F.size("__lines").cast("long"), F.lit(0).cast("long")),
        "__n_deleted": F.coalesce(deleted, F.lit(0).cast("long")),
    }).drop("__at", "__id", "__th", "__lines")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated runs deleted: doc_id, n_lines, n_deleted,
    runs (start-end of deleted lines), text."""
    got = delete_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    runs = F.array_join(F.transform("__runs", lambda r: F.concat_ws("-", r["start"], r["end"])), ",")
    return got.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_deleted").alias("n_deleted"),
                      F.coalesce(runs, F.lit("")).alias("runs"), "text")


def dedup_sql(source: str, min_words: int = MIN_WORDS) -> str:
    """CTEs over ``source`` (doc_id, text), ids unique, ending in table ``cut``:
    doc_id, n_lines, n_deleted, runs, text."""
    word = "'[^\\x20\\x09-\\x0D]+'"
    return f"""
l0 as (select doc_id, unnest(string_split(text, chr(10))) as s, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from {source}),
l as (select *, len(regexp_extract_all(s, {word})) as w from l0),
nb as (select *, sum(w) over (partition by doc_id order by i) as c, row_number() over (partition by doc_id order by i) as q from l where w > 0),
fw as (select a.doc_id, a.i as s, arg_min(b.i, b.q) as e from nb a join nb b on a.doc_id = b.doc_id and b.q between a.q and a.q + {min_words} and b.c - a.c + a.w >= {min_words} group by a.doc_id, a.i),
bw as (select b.doc_id, arg_max(a.i, a.q) as s, b.i as e from nb a join nb b on a.doc_id = b.doc_id and a.q between b.q - {min_words} and b.q and b.c - a.c + a.w >= {min_words} group by b.doc_id, b.i),
sp as (select 0 as kind, * from fw union all select 1, * from bw),
k as (select sp.kind, sp.doc_id, sp.s, sp.e, string_agg(nb.s, chr(10) order by nb.i) as t from sp join nb on nb.doc_id = sp.doc_id and nb.i between sp.s and sp.e group by all),
o as (select *, row_number() over (partition by kind, t order by doc_id, s) as n from k),
del as (select distinct o.doc_id, l.i from o join l on l.doc_id = o.doc_id and l.i between o.s and o.e where n > 1),
rg as (select doc_id, min(i) as s, max(i) as e from (select doc_id, i, i - row_number() over (partition by doc_id order by i) as g from del) group by doc_id, g),
rn as (select doc_id, string_agg(s || '-' || e, ',' order by s) as runs from rg group by doc_id),
ct as (select l.doc_id, count(*) as n_lines, count(del.i) as n_deleted, coalesce(string_agg(l.s, chr(10) order by l.i) filter (del.i is null), '') as t
  from l left join del on l.doc_id = del.doc_id and l.i = del.i group by l.doc_id),
cut as (select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_deleted, 0) as n_deleted, coalesce(runs, '') as runs,
    case when d.text is null then null else t end as text
  from {source} d left join ct using (doc_id) left join rn using (doc_id))"""


SQL = f"with {dedup_sql('documents')} select doc_id, n_lines, n_deleted, runs, text from cut"
