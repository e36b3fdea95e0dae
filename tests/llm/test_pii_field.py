"""The skip-chain field: messages against enumeration, long texts, recall of planted writings."""
import itertools
import random
import time

import numpy as np
import pytest

from sluice.llm import pii
from tests.llm.test_free import docs


def _nodes(r, keys, label=lambda k: -1):
    out = []
    for k, key in enumerate(keys):
        f = np.zeros(pii.N_FEATURES)
        f[0] = 1
        f[r.randint(1, 20)] = 1
        out.append(pii.Node(30 * k, 30 * k + 10, label(k), key, f, f))
    return out


def _exact(ns, w):
    n, labels = len(ns), pii.OTHER + 1
    chain, skip = pii.edges(ns)
    p = np.zeros((n, labels))
    for y in itertools.product(range(labels), repeat=n):
        if any(a.label >= 0 and a.label != b for a, b in zip(ns, y, strict=True)):
            continue
        score = sum(float(a.features @ w.unary[:, b]) for a, b in zip(ns, y, strict=True))
        score += sum(w.chain[y[a], y[b]] for a, b in chain) + sum(w.skip[y[a], y[b]] for a, b in skip)
        for k, b in enumerate(y):
            p[k, b] += np.exp(score)
    return p / p.sum(axis=1, keepdims=True)


def _weights(r, size):
    g = np.random.default_rng(r.randint(0, 10**6))
    sym = lambda m: (m + m.T) / 2
    labels = pii.OTHER + 1
    return pii.Weights(g.normal(size=(pii.N_FEATURES, labels)), sym(g.normal(size=(labels, labels))) * size, np.eye(labels) * size)


@pytest.mark.parametrize("seed", range(5))
def test_messages_are_exact_without_loops_and_close_on_loops(seed):
    r = random.Random(seed)
    line = _nodes(r, ["a", "b", "c", "d", "e"], lambda k: 2 if k == 3 else -1)
    w = _weights(r, 1.0)
    assert np.allclose(pii.marginals(line, w), _exact(line, w), atol=1e-6)
    loop = _nodes(r, ["a", "b", "a", "c", "b", "a"], lambda k: 1 if k == 0 else -1)   # chain and skip edges cross
    w = _weights(r, 0.5)
    assert np.abs(pii.marginals(loop, w, rounds=40) - _exact(loop, w)).max() < 0.05


def test_counted_rows_fit_like_the_texts(spark):
    r = random.Random(1)
    texts = [f"call +1 555 {r.randint(100, 999)} {r.randint(1000, 9999)} or 10.0.0.{k} and mail a{k % 7}@b.org, order {r.randint(10**7, 10**8)}" for k in range(80)]
    a, b = pii.fit(texts), pii.train(docs(spark, list(enumerate([*texts, *texts, None, ""]))))
    for x, y in ((a.unary, b.unary), (a.chain, b.chain), (a.skip, b.skip)):
        assert np.allclose(x, y, atol=1e-9)
    assert np.allclose(pii.train(docs(spark, [])).unary, pii.prior().unary)


def test_free_is_no_overlap():
    r = random.Random(2)
    for _ in range(300):
        taken = [(a, a + r.randint(1, 6)) for a in (r.randint(0, 40) for _ in range(r.randint(0, 8)))]
        free = pii._free(taken)
        for _ in range(20):
            a = r.randint(0, 45)
            b = a + r.randint(1, 5)
            assert free(a, b) == (not any(x < b and a < y for x, y in taken))


@pytest.mark.parametrize("text", [
    "mail x@y.org now " * 32_000, "12345678 and 10.0.0.1, " * 32_000, "1" * 1_000_000 + " a.b.c.d", "a" * 1_000_000 + " (at) b",
    "1." * 500_000, "+1 " * 300_000, "(at)" * 200_000, "@" * 500_000, "1" + " " * 500_000 + "2345678"])
def test_long_texts_are_linear(text):
    start = time.time()
    base = pii.base_spans(text)
    pii.edges(pii.nodes(text, base))
    assert time.time() - start < 20


def test_long_local_parts_are_whole():
    text = "b" * 100 + " (at) c.org and " + "b" * 100 + "@c.org"
    got = pii.nodes(text, pii.base_spans(text))
    assert [(n.start, n.end, n.label) for n in got] == [(0, 111, -1), (116, 222, 0)] and got[0].key == got[1].key


def test_planted_writings_are_found():
    r = random.Random(3)
    texts, planted = [], []
    for k in range(300):
        n = f"{r.randint(200, 999)}{r.randint(200, 999)}{r.randint(1000, 9999)}"
        user = f"u{r.randint(0, 9999)}.x"
        head = f"Reach us: phone +1{n} or {user}@mail.example.org. "
        words = " ".join(r.choice(("see", "the", "plan", "of", "1999", "a", "room 12", "page")) for _ in range(60)) + " or "   # a number right in front would be one group with it
        other = r.choice((f"({n[:3]}) {n[3:6]}-{n[6:]}", f"{n[:3]}-{n[3:6]}-{n[6:]}", f"{n[:3]}.{n[3:6]}.{n[6:]}", f"{user} (at) mail (dot) example (dot) org"))
        texts.append(head + words + other + " today.")
        planted.append((len(head + words), len(head + words + other)))
    w = pii.fit(texts[:150])
    found = sum(any(a <= x and y <= b + 1 for a, _, b in pii.find(t, w)[1]) for t, (x, y) in zip(texts[150:], planted[150:], strict=True))
    clean = [f"Order {r.randint(10**7, 10**8)} shipped, ref {r.randint(100, 999)}-{r.randint(100, 999)}-{r.randint(10**3, 10**4)}." for _ in range(100)]
    assert found >= 0.9 * 150
    assert sum(bool(pii.find(t, w)[1]) for t in clean) == 0
