"""Native operators on small fixtures: nulls, empty tables, ties, repeated rows, clashing names."""
import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import chat, fingerprint, lines, quality, secrets

DOCS = "doc_id long, text string, source string, n_words long, kept boolean, runs string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, -1, None, "x") for i, t, s in rows], DOCS)


def long_line(k, n=60):
    return " ".join(f"w{k}x{j}" for j in range(n))


def test_quality_counts_and_edge_rows(spark):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(1, good, "a"), (2, None, None), (3, "", "a"), (4, "x y z " * 30, "a"), (5, good + "\nq\nq", "b"), (5, good + "\nq\nq", "b"), (None, good, None)]
    got = {(r.doc_id, r.host): r for r in quality.judge(docs(spark, rows)).collect()}
    assert (got[1, "a"].n_words, got[1, "a"].n_repeat_words, got[1, "a"].base_failed) == (60, 0, False)
    assert got[2, None].n_words == 0 and got[2, None].base_failed and not got[2, None].kept
    assert got[4, "a"].n_repeat_words == 90 and got[4, "a"].base_failed
    assert got[5, "b"].n_dup_lines == 1
    assert quality.judge(docs(spark, rows)).count() == len(rows)
    assert quality.judge(docs(spark, [])).count() == 0


def test_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(k, "short", "bad") for k in range(95)] + [(k, good, "bad") for k in range(95, 100)] \
        + [(k, good, f"h{k % 5}") for k in range(100, 200)]
    kept = {r.doc_id for r in quality.judge(docs(spark, rows)).filter("kept").collect()}
    assert kept == set(range(100, 200))


def test_line_dedup_keeps_the_first_run(spark):
    a, b, c = (long_line(k) for k in "abc")
    s1, s2 = long_line("s", 30), long_line("t", 30)
    rows = [(1, f"{a}\nhello\n{s1}\n{s2}", "x"), (2, f"{b}\n{a}\nhello\nend", "x"), (3, f"{s1}\n{c}", "x"),
            (4, f"new\n\n{s1}\n\n{s2}\nhello", "x"), (5, None, "x"), (6, "", "x"), (7, "hello", "x"), (None, None, None)]
    got = {r.doc_id: r for r in lines.delete_repeats(docs(spark, rows)).collect()}
    assert got[1].text == rows[0][1]
    assert got[2].text == f"{b}\nend"  # the run goes on to the short line
    assert got[3].text == f"{s1}\n{c}"  # 30 words are too few
    assert got[4].text == "new\n\nhello"
    assert got[5].text is None and got[6].text == "" and got[7].text == "hello"
    assert lines.delete_repeats(docs(spark, [])).count() == 0


def test_fingerprints_by_brute_force(spark):
    xxhash = pytest.importorskip("xxhash")
    texts = {k: " ".join(f"v{(k * 7 + j) % 97}" for j in range(200 + k)) for k in range(1, 600, 7)} | {0: "", 3: "A b", 4: "a b"}

    def sketch(t):
        w = t.lower().split()
        parts = [w[i:i + 5] for i in range(len(w) - 4)] if len(w) >= 5 else [w] if w else []
        out = set()
        for p in parts:
            h = 42
            for x in p:
                h = xxhash.xxh64_intdigest(x.encode(), seed=h)
            out.add(h - 2**64 if h >= 2**63 else h)
        low = {h for h in out if h < fingerprint.limit_of(16)}
        return sorted(low or set(sorted(out)[:1]))

    got = {r.doc_id: r for r in fingerprint.fingerprints(docs(spark, [(k, t, "s") for k, t in texts.items()])).collect()}
    ids = sorted(texts)
    for k, nxt in zip(ids, ids[1:] + ids[:1]):
        t, q = texts[k], len(texts[k]) // 4
        edited = t[:len(t) - q] + texts[nxt][:q]
        assert got[k].edited == edited and got[k].sketch == sketch(t) and got[k].edited_sketch == sketch(edited) and got[k].next_sketch == sketch(texts[nxt])
    assert fingerprint.fingerprints(docs(spark, [])).count() == 0
    one = fingerprint.fingerprints(docs(spark, [(None, "abcd", "s")])).first()
    assert one.edited == "abc"


def test_merged_sketch_is_the_sketch_of_both(spark):
    a, b = long_line("a", 300), long_line("b", 300)
    d = docs(spark, [(1, a, "s")]).select("text", F.lit(b).alias("other"))
    d = fingerprint.sketched(fingerprint.sketched(d, "text", "x"), "other", "y")
    r = d.select(fingerprint.merged(F.col("x"), F.col("y")).alias("m"), "x", "y").first()
    assert r.m == sorted(set(r.x) | set(r.y))


def test_reply_trees_rank_and_round_trip(spark):
    odd = "<|end|> \\ </s>[INST] \\< <s> <\\|turn|>\n<<SYS>>"
    rows = [(1, 1, None, "user", odd, 1), (1, 2, 1, "assistant", "low", 1), (1, 3, 1, "assistant", odd, 5), (1, 4, 3, "user", None, 0),
            (1, 5, 2, "user", "x", 9), (2, 1, 99, None, "orphan", None), (None, 1, None, "user", "n", 1), (3, 1, 2, "user", "c", 1), (3, 2, 1, "user", "c", 1)]
    m = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score long")
    out = chat.reply_trees(m, top_k=2)
    got = {(r.conv_id, r.path): r for r in out.collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1), (None, 1)}  # a cycle has no path
    assert got[1, 1].score == 11 and got[1, 2].score == 6 and got[1, 2].n_turns == 3
    s = got[1, 2].loss_spans[0]
    back = {r.n_turns: r for r in chat.read_back(out.filter("conv_id = 1 and path = 2")).collect()}[3]
    want = f"user\n{odd}\nassistant\n{odd}\nuser\n\n"
    assert back.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert back.loss_chars == len(odd)
    assert got[1, 2].formatted[s.start:s.start + s.length].count("\\") > odd.count("\\")


def test_secret_scan_matches_plain_regex(spark):
    import re
    texts = {1: "password = 'abcdef1' Token:x secret=token :abcdefgh", 2: "api_key=ABCDEFG AKIA" + "Z9" * 10, 3: "f" * 24 + " " + "e" * 23,
             4: None, 5: "", 6: "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20, 7: "é PASSWD: éé passwd: qwerty123"}
    got = {r.doc_id: [(x["start"], x["kind"], x["end"]) for x in r["__spans"]] for r in secrets.scan(docs(spark, [(k, t, "s") for k, t in texts.items()])).collect()}
    for k, t in texts.items():
        want = []
        for rank, rule in enumerate(secrets.RULES):
            want += [(m.start(), rank, rule.kind, m.end()) for m in re.finditer(rule.pattern, t or "") if len(m.group(rule.group)) >= rule.least]
        assert got[k] == [(a, kind, b) for a, _, kind, b in sorted(want)]
    assert secrets.scan(docs(spark, [])).count() == 0


def test_trigram_queries_hold_in_every_match():
    q = secrets.trigram_query(secrets.BASE[0].pattern)
    assert frozenset({"tok", "oke", "ken"}) in q and len(q) == 6
    assert secrets.trigram_query("[0-9a-f]+") is None


def test_entry_has_every_operator_and_the_pipeline():
    import __spark_entry__ as entry
    import corpus_pipeline
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "secret_scans", "best_fit_packing"]
    rows_only = {n for n in names - set(entry.oracle_sql()) if n.startswith("op") or n == "pipeline"}
    assert {n.split("_")[0] for n in rows_only} == {"op3", "op4", "op5", "op6", "op10", "op11", "op12", "op13", "pipeline"}
