"""Stages of the pipeline with null and repeated ids."""
import random

import corpus_pipeline

from .test_pipeline import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], SCHEMA)


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2])


def test_quality_rules_judges_rows(spark):
    good = [prose(random.Random(k), 80) for k in range(12)]
    clean = [(k % 3 or None, t, "h") for k, t in enumerate(good)]
    got = corpus_pipeline.quality_rules(spark, rows_of(spark, clean + [(None, "short", "h"), (1, "short", "h")]), "")
    assert sorted(((r.doc_id, r.text, r.source) for r in got.collect()), key=key) == sorted(clean, key=key)


def test_near_duplicates_keeps_one_row_of_each_group(spark):
    a, b, c, d, e = (prose(random.Random(k), 200) for k in range(5))
    rows = [(5, a, "h"), (5, a, "h"), (5, b, "h"), (None, c, "h"), (None, c + " x", "h"), (None, d, "h"), (4, d + " x", "h"), (9, a + " y", "h"), (9, e, "h")]
    got = corpus_pipeline.near_duplicates(spark, rows_of(spark, rows), "")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=lambda x: (x[0] or 0, x[1]))
    nulls = [t for i, t in kept if i is None]
    assert len(nulls) == 1 and nulls[0] in (c, c + " x")
    assert [x for x in kept if x[0] is not None] == sorted([(4, d + " x"), (5, a), (5, b), (9, e)])
