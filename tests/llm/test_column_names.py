"""Extra columns with any names pass through the stages unchanged, or are ignored."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from sluice.llm import html, jaccard, lines, packing, quality, secrets

#: Names that the operators use for columns of their own, and awkward ones.
NAMES = ("__t", "__id", "__rules", "__spans", "__at", "__th", "__runs", "__lines", "__n_deleted", "__n_lines", "__hash", "__host", "__row",
         "box", "host", "text_hash", "kept", "failed", "h", "k", "a.b", "with `tick`", "component_id", "start", "end", "key", "rules", "t")


def _docs(spark, extra=NAMES):
    long = " ".join(f"word{k}" for k in range(80))
    rows = [(1, long, "en", "a", 1), (2, long, "en", "a", 1), (None, "password = abcdefgh1 " + " ".join(f"other{k}" for k in range(70)), "en", None, 1),
            (4, None, "en", "b", 0), (5, "", None, "b", 0), (6, "short", "en", "b", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(extra):
        df = df.withColumn(name, F.concat(F.lit(f"mine {k} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return df


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES[:-1]])
def test_stages_carry_all_columns(spark, name):
    docs = _docs(spark)
    stage = dict(cp.STAGES)[name]
    got, plain = stage(spark, docs, ""), stage(spark, _docs(spark, ()), "")
    assert got.columns == docs.columns
    core = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = got.collect()
    assert sorted(map(str, ([r[c] for c in core] for r in rows))) == sorted(map(str, ([r[c] for c in core] for r in plain.collect())))
    for r in rows:
        for k, n in enumerate(NAMES):
            assert r[n] == f"mine {k} {'null' if r.doc_id is None else r.doc_id}"


def test_last_stage_ignores_them(spark):
    got = cp.best_fit_packing(spark, _docs(spark), "")
    assert got.columns == cp.best_fit_packing(spark, _docs(spark, ()), "").columns and got.count() == 6


@pytest.mark.parametrize("run", [
    lambda d: jaccard.jaccard_components(d), lambda d: quality.judge(d), lambda d: lines.repeated_runs(d),
    lambda d: packing.packed(d), lambda d: secrets.candidates(d, secrets.RULES),
    lambda d: html.extracted(d.select("*", F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))),
], ids=["op1", "op2", "op8", "op10", "op9", "op3"])
def test_operators_ignore_them(spark, run):
    assert run(_docs(spark)).count() == run(_docs(spark, ())).count()
