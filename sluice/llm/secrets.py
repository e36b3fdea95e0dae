"""Secret scans through a trigram inverted index, with DataFrame functions only.

From each rule's regex a Boolean query over trigrams is derived: alternatives, each
a set of trigrams that any match must contain (letters folded to lower case). The
index holds one posting (trigram, document) for every trigram of the rules' queries
that a document contains. Postings are intersected per rule and alternative; the
documents left are verified with the regex. A rule without a mandatory trigram
(``hex``) scans every document.

Base kinds, leftmost non-overlapping, matches that fail their length test dropped:
assign, access, hex. The method's own kinds add spans after them. Offsets are code
points, found from the pieces between matches.

Defined cases: a null or empty text has no spans; rows with equal ids share
candidates, which can only cause a needless verification; a null id is a document
like any other; spans sort by start, then kind in the order listed; an empty table
gives no rows. ``scan`` reads only the id and text columns.
"""
from __future__ import annotations

from dataclasses import dataclass
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, literal_rows, small_side, text_or_empty, written


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: Regex group whose length is tested, and the least length.
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Prefixes of public credential formats (fixed values).
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + ADDED
#: An expansion into literal strings stops beyond this many.
MOST_STRINGS = 32


def _literals(node) -> list[str] | None:
    """All strings a parsed regex part can match, lower-cased; None if too many."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return [chr(arg).lower()]
    if op == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
        return sorted({chr(a).lower() for _, a in arg})
    if op == "SUBPATTERN":
        return _sequence_literals(arg[-1])
    if op == "BRANCH":
        each = [_sequence_literals(x) for x in arg[1]]
        return None if None in each else sorted({s for x in each for s in x})
    if op == "MAX_REPEAT" and arg[1] == 1:
        inner = _sequence_literals(arg[2])
        return None if inner is None else sorted({*inner, *([""] if arg[0] == 0 else [])})
    return None


def _sequence_literals(seq) -> list[str] | None:
    out = [""]
    for node in seq:
        got = _literals(node)
        if got is None or len(got) * len(out) > MOST_STRINGS:
            return None
        out = [a + b for a in out for b in got]
    return out


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams, one of which every match contains whole; None if
    the regex has no mandatory trigram. Among the runs of literal parts, the one
    with the most trigrams in its weakest alternative is used, together with all
    runs that have only one alternative."""
    def runs(seq):
        now = [""]
        for node in seq:
            got = _literals(node)
            if got is None and str(node[0]) == "SUBPATTERN":
                yield now
                yield from runs(node[1][-1])
                now = [""]
            elif got is None and str(node[0]) == "MAX_REPEAT" and node[1][0] >= 1:
                yield now
                yield from runs(node[1][2])
                now = [""]
            elif got is None or len(got) * len(now) > MOST_STRINGS:
                yield now
                now = [""] if got is None else got
            else:
                now = [a + b for a in now for b in got]
        yield now

    found = [[_grams(s) for s in r] for r in runs(regex_parser.parse(pattern))]
    found = [alts for alts in found if all(alts)]
    if not found:
        return None
    sure = frozenset().union(*[alts[0] for alts in found if len(alts) == 1])
    best = max(found, key=lambda alts: min(map(len, alts)))
    alts = {alt | sure for alt in best}
    return sorted((a for a in alts if not any(b < a for b in alts)), key=sorted)


def query_plan(rules: tuple[Rule, ...]) -> list[dict]:
    """One row for each trigram of each alternative: rule and alternative number,
    the trigram, its bit in the alternative and the mask of all bits."""
    rows = []
    for k, rule in enumerate(rules):
        for a, alt in enumerate(trigram_query(rule.pattern) or []):
            for bit, gram in enumerate(sorted(alt)):
                rows.append({"rule": k, "alt": a, "gram": gram, "bit": 1 << bit, "mask": (1 << len(alt)) - 1})
    return rows


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """doc_id and the bit set of rules whose trigram query it meets."""
    plan = query_plan(rules)
    if not plan:
        return docs.select("doc_id", F.lit(0).cast("long").alias("rules")).limit(0)
    grams = sorted({r["gram"] for r in plan})
    folded = docs.select("doc_id", F.lower(text_or_empty()).alias("t"))
    has = F.array(*[F.when(F.contains("t", F.lit(g)), F.lit(g)) for g in grams])
    postings = folded.select("doc_id", F.explode(F.array_compact(has)).alias("gram"))
    met = postings.join(F.broadcast(literal_rows(docs.sparkSession, plan)), "gram") \
        .groupBy("doc_id", "rule", "alt").agg(F.bit_or("bit").alias("bits"), F.max("mask").alias("mask")) \
        .filter(F.col("bits") == F.col("mask"))
    return met.groupBy("doc_id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("rule"))).alias("rules"))


def _spans(rule: Rule, rank: int) -> Column:
    """Spans of one rule in column ``__t``."""
    lengths = lambda xs: F.transform(xs, lambda x: F.length(x).cast("long"))
    pieces = lengths(F.split("__t", rule.pattern))
    whole = lengths(F.regexp_extract_all("__t", F.lit(rule.pattern), F.lit(0)))
    tested = lengths(F.regexp_extract_all("__t", F.lit(rule.pattern), F.lit(rule.group))) if rule.group else whole
    zipped = F.filter(F.arrays_zip(pieces.alias("gap"), whole.alias("size"), tested.alias("test")), lambda x: x["size"].isNotNull())
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>").alias("out"))

    def step(a, x):
        end = a["at"] + x["gap"] + x["size"]
        span = F.struct((a["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(x["test"] >= rule.least, F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    return F.aggregate(zipped, start, step, lambda a: a["out"])


def _tightened(rule: Rule) -> Rule:
    """The same matches with the length test inside the regex, where a failing match
    cannot hide another: one class run that starts at its only possible start."""
    return {"access": Rule("access", r"AKIA[A-Z0-9]{16,}"), "hex": Rule("hex", r"[0-9a-f]{24,}")}.get(rule.kind, rule)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` with ``__spans``: sorted array of (start, rank, kind, end)."""
    found = written(candidates(docs, rules), "secret-candidates").select(F.col("doc_id").alias("__id"), F.col("rules").alias("__rules"))
    d = docs.withColumn("__t", text_or_empty())
    d = d.join(small_side(found, found.count()), F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    each = []
    for k, rule in enumerate(rules):
        spans = _spans(_tightened(rule), k)
        if trigram_query(rule.pattern) is not None:
            spans = F.when(F.coalesce("__rules", F.lit(0)).bitwiseAND(F.lit(1 << k)) != 0, spans).otherwise(none)
        each.append(spans)
    return d.withColumn("__spans", F.sort_array(F.concat(*each))).drop("__id", "__rules", "__t")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def mask(text: Column, spans: Column, by: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by one mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a, x):
        gap = F.when(x["start"] >= a["at"], F.concat(F.substring(text, (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit(by))) \
            .otherwise(F.lit(""))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.concat(a["out"], gap).alias("out"))

    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.lit(2**31 - 1))))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("__spans", lambda x: x["rank"] < len(BASE))
    n = lambda k: F.size(F.filter("__spans", lambda x: x["rank"] == k)).cast("long")
    return got.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                      F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"))


def spans_sql(source: str) -> str:
    """CTEs over ``source`` (doc_id, text), ids unique, ending in table ``sp``:
    doc_id, k, kind, s, e."""
    parts = []
    for k, rule in enumerate(RULES):
        p = rule.pattern.replace("'", "''")
        parts.append(
            f"select doc_id, {k} as k, '{rule.kind}' as kind, unnest(range(1, len(m) + 1)) as j, m, g, p from (select doc_id, "
            f"regexp_extract_all(text, '{p}') as m, regexp_extract_all(text, '{p}', {rule.group}) as g, "
            f"string_split_regex(text, '{p}') as p from {source} where text is not null and regexp_matches(text, '{p}'))")
    least = " ".join(f"when {k} then {rule.least}" for k, rule in enumerate(RULES))
    return f"""
ma as ({' union all '.join(parts)}),
po as (select doc_id, k, kind, length(m[j]) as n, length(g[j]) as t,
  list_sum(list_transform(p[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:j - 1], lambda x: length(x))), 0) as s from ma),
sp as (select doc_id, k, kind, s::bigint as s, (s + n)::bigint as e from po where t >= case k {least} end)"""


SQL = f"""with {spans_sql('documents')},
a as (select doc_id, count(*) filter (k = 0) as n0, count(*) filter (k = 1) as n1, count(*) filter (k = 2) as n2,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, k) filter (k < {len(BASE)}) as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, k) as spans from sp group by doc_id)
select d.doc_id, coalesce(n0, 0) as n_assign, coalesce(n1, 0) as n_access, coalesce(n2, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join a using (doc_id)"""
