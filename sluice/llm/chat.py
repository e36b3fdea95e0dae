"""Chat formatting by reply trees, with DataFrame functions only.

Messages form trees (``parent`` names another message of the conversation). A
table of ancestors 1, 2, 4, ... steps up is built by self-joins, so a path of
n messages takes log2(n) joins. Every leaf gets its path's length and score from
the same joins; the best ``top_k`` leaves of each conversation are chosen, their
paths are expanded with the ancestor tables and each path becomes one text.

Template: ``<|turn|>role<|text|>text<|end|>`` for every turn. In roles and texts
a backslash is doubled and a backslash is put after the first character of each
control string, so no control string is left in them; undoing it is one
replacement of ``\\x`` by ``x``.

Defined cases: a null text or role is empty; a null conversation id is a
conversation of its own; a parent that does not exist makes its child a root;
messages on or below a cycle have no root and so no path; equal scores rank by
leaf node; repeated turns are separate messages, ordered by turn, role, text; an
empty table gives no rows. Extra columns are ignored.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import literal_rows, written

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings that must not be read as such inside a text (fixed values of
#: public chat templates; the first covers every ``<|...|>`` mark).
CONTROL = ("<|", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")
KEY = ("__c", "__cn")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        out = F.replace(out, F.lit(s), F.lit(f"{s[0]}\\{s[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turns_as_chains(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation table as messages: each answers the one before."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        "conv_id", F.row_number().over(w).cast("long").alias("node"), "role", "text",
    ).select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
             F.length(F.coalesce("text", F.lit(""))).cast("long").alias("score"))


def ancestors(nodes: DataFrame, n_nodes: int) -> tuple[list[DataFrame], DataFrame]:
    """Ancestor tables ``(key, node, jump)`` for 1, 2, 4, ... steps, and per node
    that hangs on a root its ``depth`` (root: 1) and path ``score``."""
    up, levels = nodes, []
    for k in range(math.ceil(math.log2(n_nodes + 1)) + 1):
        up = written(up, f"chat-up{k}")
        if up.filter(F.col("jump").isNotNull()).isEmpty():
            break
        levels.append(up.filter(F.col("jump").isNotNull()).select(*KEY, "node", "jump"))
        over = up.select(*KEY, F.col("node").alias("jump"), F.col("jump").alias("far"),
                         F.col("depth").alias("d2"), F.col("score").alias("s2"))
        up = up.join(over, [*KEY, "jump"], "left").select(
            *KEY, "node", F.col("far").alias("jump"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"),
            (F.col("score") + F.coalesce("s2", F.lit(0))).alias("score"))
    return levels, up.filter(F.col("jump").isNull()).drop("jump")


def reply_trees(messages: DataFrame, top_k: int = 1, trained_role: str = "assistant") -> DataFrame:
    """``messages``: conv_id, node, parent, role, text, score. One row per chosen
    root-to-leaf path: conv_id, path (rank from 1), n_turns, score, formatted,
    loss_turns (per turn: is it trained on) and loss_spans (code-point offset and
    length of each trained text in ``formatted``)."""
    m = messages.select(F.coalesce("conv_id", F.lit(0)).alias("__c"), F.col("conv_id").isNull().alias("__cn"),
                        "node", "parent", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0)).alias("score"))
    m = written(m, "chat-messages")
    known = m.select(*KEY, F.col("node").alias("parent"), F.col("node").alias("jump")).distinct()
    base = m.select(*KEY, "node", "parent", "score").join(known, [*KEY, "parent"], "left") \
        .select(*KEY, "node", "jump", F.lit(1).cast("long").alias("depth"), "score")
    levels, rooted = ancestors(base, m.count())
    rooted = written(rooted, "chat-rooted")
    parents = base.filter(F.col("jump").isNotNull()).select(*KEY, F.col("jump").alias("node")).distinct()
    leaves = rooted.join(parents, [*KEY, "node"], "left_anti")
    best = Window.partitionBy(*KEY).orderBy(F.desc("score"), "node")
    paths = leaves.withColumn("path", F.row_number().over(best)).filter(F.col("path") <= top_k) \
        .select(*KEY, "path", "node", F.col("score").alias("path_score"))
    for level in reversed(levels):
        paths = paths.join(level, [*KEY, "node"], "left").select(
            *KEY, "path", "path_score", F.explode(F.array_compact(F.array("node", "jump"))).alias("node"))
    turns = paths.join(rooted.select(*KEY, "node", "depth"), [*KEY, "node"]) \
        .join(m.select(*KEY, "node", "role", "text"), [*KEY, "node"]).select(
            *KEY, "path", "path_score", "depth", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
            escape(F.col("text")).alias("body"), (F.col("role") == trained_role).alias("trained"))
    before = Window.partitionBy(*KEY, "path").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    turns = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    made = turns.groupBy(*KEY, "path").agg(
        F.max("path_score").alias("score"), F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("depth", "head", "body", "trained", "at"))).alias("t"))
    return made.select(
        F.when(~F.col("__cn"), F.col("__c")).alias("conv_id"), "path", "n_turns", "score",
        F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("formatted"),
        F.transform("t", lambda x: x["trained"]).alias("loss_turns"),
        F.transform(F.filter("t", lambda x: x["trained"]),
                    lambda x: F.struct(x["at"].alias("start"), F.length(x["body"]).cast("long").alias("length"))).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and trained texts as read from the formatted text and its mask."""
    parts = F.filter(F.split("formatted", r"<\|end\|>"), lambda p: p != "")
    turns = F.transform(parts, lambda p: F.split(p, r"<\|text\|>"))
    got = formatted.withColumn("__t", turns)
    return got.withColumns({
        "__turns": F.transform("__t", lambda p: F.concat(
            unescape(F.substring(p[0], len(TURN) + 1, 2**31 - 1)), F.lit("\n"), unescape(p[1]), F.lit("\n"))),
        "__loss": F.transform(F.filter("__t", lambda p, i: F.get("loss_turns", i)), lambda p: unescape(p[1])),
    }).select("conv_id", F.size("__t").cast("long").alias("n_turns"),
              F.sha2(F.array_join("__turns", ""), 256).alias("turns_sha256"),
              F.length(F.array_join("__loss", "")).cast("long").alias("loss_chars"),
              F.sha2(F.array_join("__loss", ""), 256).alias("loss_sha256"),
              F.length("formatted").cast("long").alias("formatted_chars"))


CHECK_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = literal_rows(spark, [{"conv_id": -1, "turn": i, "role": r, "text": CHECK_TEXT}
                               for i, r in enumerate(("user", "assistant"))])
    return read_back(reply_trees(turns_as_chains(table.unionByName(own))))


def _sql_escaped(x: str) -> str:
    out = f"replace({x}, '\\', '\\\\')"
    for s in CONTROL:
        out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
    return out


SQL = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{CHECK_TEXT}' union all select -1, 1, 'assistant', '{CHECK_TEXT}')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum({len(TURN) + len(TEXT) + len(END)} + length({_sql_escaped('role')}) + length({_sql_escaped('text')}))::bigint as formatted_chars
from c group by conv_id"""
