"""Property tests: the block-based operators against brute force in Python
on random inputs (few examples each; every example is a Spark job)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import log_df
from sluice.functions.numbering import dense_sequence, running_total
from sluice.operators import dedup, delivery, landing
from sluice.operators.spec import TableSpec

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 10_000)), min_size=1, max_size=120,
                unique_by=lambda t: t), st.integers(1, 500))
def test_dense_sequence_matches_brute_force(spark, rows, block):
    df = spark.createDataFrame(rows, "g string, o long")
    got = {(r.g, r.o): r.n for r in dense_sequence(df, ["g"], "o", F.floor(F.col("o") / block), "n").collect()}
    want = {}
    for g in "abc":
        for i, o in enumerate(sorted(o for gg, o in rows if gg == g)):
            want[(g, o)] = i
    assert got == want


@SETTINGS
@given(st.dictionaries(st.integers(0, 5000), st.integers(-50, 50), min_size=1, max_size=100), st.integers(1, 700))
def test_running_total_matches_brute_force(spark, series, block):
    df = spark.createDataFrame(sorted(series.items()), "t long, v long")
    got = {r.t: r.s for r in running_total(df, "t", "v", F.floor(F.col("t") / block), "s").collect()}
    acc, want = 0, {}
    for t in sorted(series):
        acc += series[t]
        want[t] = acc
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6), st.integers(0, 20)), min_size=1, max_size=80))
def test_keep_first_matches_brute_force(spark, rows):
    full = [("t", p, o, pt, f"v{i}") for i, (p, o, pt) in enumerate(rows)]
    df = spark.createDataFrame(full, "topic string, partition int, offset long, push_time long, v string")
    got = {(r.partition, r.offset): (r.push_time, r.v) for r in dedup.keep_first(df).collect()}
    want = {}
    for _, p, o, pt, v in full:
        if (p, o) not in want or (pt, v) < want[(p, o)]:
            want[(p, o)] = (pt, v)
    assert got == want
    counts = {}
    for _, p, o, _, _ in full:
        counts[(p, o)] = counts.get((p, o), 0) + 1
    kept = {(r.partition, r.offset) for r in dedup.drop_duplicated_keys(df).collect()}
    assert kept == {k for k, n in counts.items() if n == 1}


@SETTINGS
@given(st.lists(st.booleans(), min_size=1, max_size=60), st.integers(1, 9), st.integers(1, 16))
def test_error_cap_matches_brute_force(spark, bad, k, block):
    spec = TableSpec.from_tuples("t", [("n", "bigint", None)])
    rows = [("t", 0, i, '{"n":"x"}' if b else '{"n":1}') for i, b in enumerate(bad)]
    v = landing.validate(log_df(spark, rows), spec, keep=("topic", "partition", "offset"))
    r = delivery.error_cap(v, k, block_size=block).first()
    errs = [i for i, b in enumerate(bad) if b]
    stop = errs[k - 1] if len(errs) >= k else None
    assert r.stop_offset == stop
    assert r.rows_sent == (stop + 1 if stop is not None else len(bad))
    assert r.errors_seen == min(k, len(errs))


KEYS = st.sampled_from(["c1", "C1", "c2", "C2", "x"])


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(KEYS, st.integers(0, 99)), max_size=6), min_size=1, max_size=10))
def test_case_insensitive_last_wins(spark, payloads):
    spec = TableSpec.from_tuples("t", [("c1", "bigint", None), ("c2", "bigint", None)])
    # JSON text with the keys in order (duplicates allowed, as on the wire)
    texts = ["{" + ",".join(f'"{k}":{v}' for k, v in p) + "}" for p in payloads]
    df = log_df(spark, [("t", 0, i, t) for i, t in enumerate(texts)])
    got = {r.offset: (r.c1, r.c2) for r in landing.land_by_name(df, spec, keep=("offset",)).collect()}
    for i, p in enumerate(payloads):
        last = {}
        for k, v in p:                  # the last key in the payload text wins
            last[k.lower()] = v
        assert got[i] == (last.get("c1"), last.get("c2")), (texts[i], got[i])
