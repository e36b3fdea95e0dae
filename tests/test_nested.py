"""Nested inference and evolution: types by path, structs and arrays as columns."""
import tempfile

import pytest
from conftest import log_df
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import nested
from sluice.operators.spec import ColumnSpec, TableSpec
from sluice.streaming import landing as sl
from sluice.streaming.manifest import LandedTable


def _paths(df, **kw):
    return {r.path: (r.inferred_type, r.n_values) for r in nested.infer_paths(df, **kw).collect()}


def _df(spark, *values):
    return log_df(spark, [("t", 0, k, v) for k, v in enumerate(values)])


def test_types_by_path(spark):
    got = _paths(_df(spark, '{"A":{"n":1,"d":"2026-04-13","e":[]},"l":[1,2.5,null],"o":[{"x":"a"},{"x":true,"y":{"z":3}}]}',
                     '{"a":{"n":"7","d":null},"l":[],"m":1}', '{"m":{"in":1}}', "text", None, "[1]", "{}"))
    assert got == {"a": ("OBJECT", 2), "a.n": ("BIGINT", 2), "a.d": ("DATE", 1), "a.e": ("ARRAY", 1), "l": ("ARRAY", 2),
                   "l[]": ("DECIMAL", 2), "o": ("ARRAY", 1), "o[]": ("OBJECT", 2), "o[].x": ("VARCHAR", 2),
                   "o[].y": ("OBJECT", 1), "o[].y.z": ("BIGINT", 1), "m": ("VARCHAR", 2), "m.in": ("BIGINT", 1)}
    assert _paths(_df(spark, '{"d":"2026-04-13"}'), dates_as_text=True) == {"d": ("VARCHAR", 1)}


def test_depth_is_found(spark):
    deep = '{"a":' * 11 + "1" + "}" * 11
    got = _paths(_df(spark, deep, '{"a":{"b":2}}'))
    assert got[".".join("a" * 11)] == ("BIGINT", 1) and len(got) == 12


def test_a_repeated_key_is_read_at_the_top(spark):
    assert _paths(_df(spark, '{"a":1,"a":2,"b":{"c":1}}')) == {"a": ("BIGINT", 2), "b": ("VARCHAR", 1)}


def test_empty_input(spark):
    empty = log_df(spark, [("t", 0, 0, None)]).limit(0)
    assert _paths(empty) == {} and nested.column_types(nested.path_summary(empty)) == {}


def test_summaries_merge_to_the_whole(spark):
    values = ['{"a":{"n":1}}', '{"a":{"n":1.5,"k":true}}', '{"A":{"n":3}}', '{"a":{"k":"x"},"b":[{"c":1}]}', '{"b":[{"c":"2026-01-01"}]}']
    key = lambda d: sorted((tuple(r.steps), r.mask, r.n_values) for r in d.collect())
    parts = [nested.path_summary(_df(spark, *values[k:k + 2])) for k in (0, 2, 4)]
    whole = nested.path_summary(_df(spark, *values))
    assert key(nested.merge_paths(*parts)) == key(nested.merge_paths(*parts[::-1])) == key(whole)


def test_column_types(spark):
    s = nested.path_summary(_df(spark, '{"A":{"n":1,"t":["x"]},"o":[{"x":1,"X":2}],"e":{},"m":1}', '{"m":{"k":1},"odd":{"a b.c":1}}'))
    got = {k: nested.ddl(t) for k, t in nested.column_types(s).items()}
    assert got == {"a": "struct<`n`:bigint,`t`:array<string>>", "o": "array<string>", "e": "string", "m": "string",
                   "odd": "struct<`a b.c`:bigint>"}
    with pytest.raises(ValueError):
        nested.column_types(s, max_paths=3)


def test_widened_keeps_landed_types():
    t = T._parse_datatype_string
    old, new = t("struct<a:bigint,l:array<struct<x:int>>>"), t("struct<A:string,l:array<struct<x:string,y:date>>,b:boolean>")
    assert nested.ddl(nested.widened(old, new)) == "struct<`a`:bigint,`l`:array<struct<`x`:int,`y`:date>>,`b`:boolean>"
    assert nested.widened(old, T.StringType()) == old


def test_strict_inside_nested_columns(spark):
    from sluice.functions import casts
    t = "struct<n:bigint,l:array<struct<x:date>>>"
    values = ['{"n":1}', '{"n":1.5}', '{"n":null,"l":[{"x":"2026-01-01"},{},null]}', '{"l":[{"x":"2026"}]}', '{"l":{}}',
              "[]", "null", "x", None, '{"other":[1]}']
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    got = {r.k: r.j for r in df.select("k", F.to_json(casts.cast_text(F.col("v"), t)).alias("j")).collect()}
    assert got == {0: '{"n":1}', 1: None, 2: '{"l":[{"x":"2026-01-01"},{},null]}', 3: None, 4: None, 5: None, 6: None, 7: None,
                   8: None, 9: "{}"}


def test_nested_columns_over_epochs_and_compaction(spark):
    base = tempfile.mkdtemp(prefix="sluice-nested-", dir="/tmp")
    target, errors = base + "/t", base + "/e"
    spec = TableSpec("t", (ColumnSpec("id", "bigint"),), evolve=True, nested=True)
    batches = ['{"id":1}', '{"id":2,"a":{"n":1},"l":[{"x":1}]}', '{"id":3,"a":{"n":2,"k":"v"},"l":[{"x":2,"y":"2026-01-01"}]}']
    for e, value in enumerate(batches):
        sl.land_batch(log_df(spark, [("u", 0, e, value)]), e, spec, target, errors)
    sl.land_batch(log_df(spark, [("u", 0, 3, '{"id":4,"a":{"n":"many"}}'), ("u", 0, 4, '{"id":5,"a":{"n":9}}')]), 3, spec, target, errors)
    want = {1: (None, None, None), 2: (1, None, None), 3: (2, "v", "2026-01-01"), 5: (9, None, None)}

    def rows():
        d = sl.read_landed(spark, target)
        return {r.id: (r.n, r.k, r.y) for r in
                d.select("id", "a.n", "a.k", F.col("l")[0]["y"].cast("string").alias("y")).collect()}

    assert rows() == want
    bad = spark.read.parquet(errors).collect()
    assert [(r.offset, r.error_reasons) for r in bad] == [(3, "a:invalid_struct")]
    LandedTable(spark, target).compact(through=1)      # parts know less of the structs than later epochs
    assert rows() == want
    LandedTable(spark, target).compact()
    assert rows() == want


def test_payloads_are_read_once_and_to_the_last_level(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def payload(k):
        read.add(1)
        return '{"a":{"b":[{"c":%d}]},"e":[]}' % k

    df = spark.range(0, 10, 1, 2).select(payload("id").alias("value"))
    found = {r.path: (r.inferred_type, r.n_values) for r in nested.infer_paths(df).collect()}
    assert read.value == 10                   # 20 before: once for the depth
    assert found == {"a": ("OBJECT", 10), "a.b": ("ARRAY", 10), "a.b[]": ("OBJECT", 10), "a.b[].c": ("BIGINT", 10), "e": ("ARRAY", 10)}
    deep = _paths(_df(spark, '{"a":[[[{"b":[{"c":{"d":[true]}}]}]]],"":1}'))
    assert deep["a[][][].b[].c.d[]"] == ("BOOLEAN", 1) and len(deep) == 10
