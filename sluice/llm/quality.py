"""Quality rules with host verdicts, with DataFrame functions only.

Document rules count what a text is made of. Failures are summed by host
(``source``); each host's failure rate is shrunk towards the corpus by a beta
prior fitted to all hosts (method of moments), so a host with few documents is
judged by the corpus and one with many by itself. A host whose shrunk rate is
over ``reject_rate`` is rejected with all its documents; a document is also
rejected by its own rules.

Rules: fewer than 50 words, or over half of the words in repeated 3-word windows
(the base rules); symbols for over a fifth of the characters of the words; over
half of the non-blank lines repeated.

Defined cases: a null or empty text has no words and fails; a null host is a host
of its own; repeated rows are separate documents; when all hosts have the same
rate, the prior has the weight ``MAX_WEIGHT``; an empty table gives no rows.
Extra columns are ignored by ``judge``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, documents, text_or_empty, words, written

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
REJECT_RATE = 0.5
#: Bounds of the prior's weight, in documents.
MIN_WEIGHT, MAX_WEIGHT = 2.0, 1000.0


def _repeated(at: str) -> Column:
    """Positions whose window hash stands next to an equal one in the sorted list."""
    near = lambda x, i: (F.get(at, i - 1)["h"] == x["h"]) | (F.get(at, i + 1)["h"] == x["h"])
    return F.sort_array(F.transform(F.filter(at, lambda x, i: F.coalesce(near(x, i), F.lit(False))), lambda x: x["i"]))


def text_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns with n_words, word_chars, n_symbols, n_lines, n_dup_lines
    and n_repeat_words of the whole text."""
    t = text_or_empty()
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    a = docs.select(
        *keep, words(t).alias("__w"), F.length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"), lines.alias("__l"))
    windows = F.transform(F.sequence(F.lit(0), F.size("__w") - 3), lambda i: F.struct(
        F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)).alias("h"), i.alias("i")))
    b = a.select(*keep, F.size("__w").cast("long").alias("n_words"), "word_chars", "n_symbols",
                 F.size("__l").cast("long").alias("n_lines"),
                 (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
                 F.when(F.size("__w") >= 3, F.sort_array(windows)).alias("__g"))
    c = b.withColumn("__p", F.when(F.col("__g").isNotNull(), _repeated("__g")))
    covered = F.aggregate(
        F.transform("__p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("__p", i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda s, x: s + x)
    return c.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__g", "__p")


def failures(counts: DataFrame) -> DataFrame:
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    own = (5 * F.col("n_symbols") > F.col("word_chars")) | (2 * F.col("n_dup_lines") > F.col("n_lines"))
    return counts.withColumn("base_failed", base).withColumn("failed", base | own)


def host_verdicts(judged: DataFrame, reject_rate: float = REJECT_RATE) -> DataFrame:
    """One row per host: n_docs, n_failed, shrunk rate, host_kept."""
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"),
                                       F.sum(F.col("failed").cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    # two numbers for the whole corpus
    m, v = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    m = m or 0.0
    weight = MAX_WEIGHT if not v else min(max(m * (1 - m) / v - 1, MIN_WEIGHT), MAX_WEIGHT)
    shrunk = (F.col("host_failed") + F.lit(weight * m)) / (F.col("host_docs") + F.lit(weight))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_kept", shrunk <= reject_rate)


def text_hash() -> Column:
    return F.sha2("text", 256)


def judge(docs: DataFrame, host: str = "source", id_col: str = "doc_id", with_hash: bool = False) -> DataFrame:
    """One row per document: the counts, base_failed, failed, host figures, kept;
    ``with_hash`` adds the text's hash, by which rows with one id are told apart."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(host).alias("host"), F.col("text").alias("text"))
    keep = ["doc_id", "host"]
    if with_hash:
        d, keep = d.withColumn("text_hash", text_hash()), [*keep, "text_hash"]
    counted = written(failures(text_counts(d, keep)), "quality")
    hosts = host_verdicts(counted).withColumnRenamed("host", "__host")
    return counted.join(hosts, F.col("host").eqNullSafe(F.col("__host")), "left").drop("__host") \
        .withColumn("kept", ~F.col("failed") & F.col("host_kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = f"""
with w as (
  select doc_id, source as host, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
  from documents),
g as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from g) where n > 1),
p as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from r) group by doc_id),
c as (
  select w.doc_id, host, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    len(l) as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(p.n, 0)::bigint as n_repeat_words
  from w left join p using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words or 5 * n_symbols > word_chars or 2 * n_dup_lines > n_lines as failed from c),
h as (select host, count(*) as n, sum(failed::int) as k from f group by host),
m as (select avg(k / n) as m, var_pop(k / n) as v from h),
q as (select m, case when v = 0 or v is null then {MAX_WEIGHT} else least(greatest(m * (1 - m) / v - 1, {MIN_WEIGHT}), {MAX_WEIGHT}) end as s from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not failed and (k + s * m) / (n + s) <= {REJECT_RATE} as kept
from f join h on f.host is not distinct from h.host, q"""
