"""Spelling variants against a plain dictionary of edits."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import spelling

DOCS = "doc_id long, text string, word string, n long, leaf long, size long"


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: set() for w in words}
    by_key = {}
    for w in words:
        for k in range(len(w)):
            by_key.setdefault(("*", w[:k], w[k + 1:]), []).append(w)
            if (u := w[:k] + w[k + 1:]) in words:
                near[w].add(u), near[u].add(w)
    for same in by_key.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {w: min(near[w], key=lambda u: (-words[u], u), default=None) for w in words}
    form = {w: u if u and words[u] >= 2 * words[w] else None for w, u in form.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def corpus(seed, n_words, n_docs, alphabet="abcdeé"):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(4, 9))) for _ in range(n_words)]
    docs = []
    for k in range(n_docs):
        own = []
        for _ in range(60):
            w = base[min(int(rnd.expovariate(8 / n_words)), n_words - 1)]
            if rnd.random() < 0.2:
                c = rnd.randrange(len(w))
                w = rnd.choice([w[:c] + w[c + 1:], w[:c] + rnd.choice(alphabet) + w[c:], w[:c] + rnd.choice(alphabet) + w[c + 1:]])
            own.append(w.title() if rnd.random() < 0.1 else w)
        docs.append((k, " ".join(own)))
    return docs


def result(spark, rows):
    d = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], DOCS)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_forms(d).collect()}


@pytest.mark.parametrize("upper", [False, True])
def test_results_by_brute_force(spark, monkeypatch, upper):
    rows = corpus(7, 300, 600) + [(None, "Wörter wörter WÖRTER wörtern"), (None, "wörtern wörtern ÀÉÎ×÷ àéî×÷ " * 3), (500, None), (501, ""), (5, "abcde " * 50)]
    rows += [(600, f"{'z' * 700}a {'z' * 700} " * 4)]
    if upper:  # several leaves in the upper trees, hot ones in chunks, lower trees with few points
        for name, value in (("PART", 8), ("PER_LEAF", 8), ("HOT", 20), ("LEAF", 3), ("QUERIES", 50), ("BLOCK", 3000), ("MANY", 2)):
            monkeypatch.setattr(spelling, name, value)
        d = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], DOCS)
        words = [r.word for r in spelling.word_counts(d).collect()]
        leaf = spelling.Tree(spelling.vectors(spelling.letters(sorted(w for w in words if len(w) == 6), 6)), 8)
        assert len(leaf.held) > 8
    want = brute(rows)
    got = result(spark, rows)
    assert got == want and len(want) > 300 and sum(v[3] for v in want.values()) > 300


def test_chains_lead_to_one_root(spark):
    chain = ["spell", "spelt", "spolt", "spolts", "spoolts"]
    rows = [(k, " ".join([w] * 3 * 3 ** k)) for k, w in enumerate(chain)]
    got = result(spark, rows)
    want = brute(rows)
    assert got == want and {v[1] for w, v in got.items() if w in chain[:4]} == {"spoolts"}


def test_ties_and_rows(spark):
    rows = [(1, "grades trades " * 6 + "brades " * 3), (1, "grades trades"), (2, None)]
    got = result(spark, rows)
    assert got == brute(rows) and got["brades"][0] == "grades"
    assert result(spark, []) == {} and result(spark, [(1, None), (None, "")]) == {}


def test_large_anagram_classes_by_lookup(monkeypatch):
    rnd = random.Random(3)
    a = sorted({"".join(rnd.sample("aabbcc", 6)) for _ in range(60)})
    b = sorted({"".join(rnd.sample("aabbcd", 6)) for _ in range(60)})
    c = sorted({"".join(rnd.sample("aabbccd", 7)) for _ in range(200)})
    for left, right in ((a, b), (a, c)):
        q, p = spelling.Classes(left), spelling.Classes(right)
        pairs = (np.array([0]), np.array([0]))
        plain = {(x, y) for i, j in spelling.near_words(p, q, pairs) for x, y in zip(i.tolist(), j.tolist())}
        monkeypatch.setattr(spelling, "MANY", 1)
        looked = {(x, y) for i, j in spelling.near_words(p, q, pairs) for x, y in zip(i.tolist(), j.tolist())}
        monkeypatch.undo()
        assert plain == looked and plain
