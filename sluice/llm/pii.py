"""Personal data by rules and a skip-chain conditional random field.

The rules find the base spans, leftmost non-overlapping per kind. The field then
labels what the rules cannot decide: its nodes are the base spans (their labels are
given) and other number groups and address-like tokens, in text order. Neighbouring
nodes share a chain potential, and nodes with the same key (the same digits, the last
seven digits, or the same address in any writing) share a skip potential, however far
apart. Loopy sum-product message passing gives marginals; a node whose most likely
label is a kind with at least ``SURE`` becomes an added span. So a number or address
that the rules know in one place is found in its other writings too.

Weights are fitted by pseudo-likelihood on at most ``SAMPLE`` distinct texts (those with
the smallest hashes), labelled by the rules. Tasks turn these texts into rows of features;
equal rows are counted, and only the distinct ones come to the driver. Base nodes are also shown
without the features that the rules look at, so that the field learns to rely on
equal neighbours; other writings of a base span's value (the same key) have its label, or
none if base spans of several kinds have that key.

Neighbours more than ``NEAR`` characters apart share no chain potential; skip potentials
have no limit. A very long text takes time in proportion to its length.

Defined cases: a null or empty text has no spans; repeated rows and null ids are
documents like others; with an empty table, or no base span in the sample, the weights
are the prior ones (equal keys agree); spans sort by start, then kind in the order
listed. Extra columns are ignored.
"""
from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, shipped, text_or_empty

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
SAMPLE = 2000
SURE = 0.9
ROUNDS = 8
#: Nodes further apart than this many characters are not chained.
NEAR = 200

# -- rules -----------------------------------------------------------------------

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MAYBE = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    if not _MAYBE.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if text.count(".") >= 3:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(out)


# -- nodes -----------------------------------------------------------------------

_NUMBER = re.compile(r"[(]?[0-9][0-9\x20().-]*[0-9]")
#: An address from its sign on; the part in front is read backwards.
_ADDRESS = re.compile(r"(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]+)*")
_CUES = {w: k for k, ws in enumerate((("mail", "email", "e-mail", "contact"), ("ip", "host", "server", "addr"),
                                     ("card", "visa", "credit", "iban"), ("phone", "tel", "call", "mobile", "fax"))) for w in ws}
N_FEATURES = 24


@dataclass
class Node:
    start: int
    end: int
    label: int  # base label, -1: open
    key: str
    features: np.ndarray
    hidden: np.ndarray  # without what the rules look at


def _key(piece: str) -> str:
    digits = _NOT_DIGIT.sub("", piece)
    if "@" in piece or "at" in piece:
        return re.sub(r"\x20?[(\[]at[)\]]\x20?", "@", re.sub(r"\x20?[(\[]dot[)\]]\x20?", ".", piece)).lower()
    return digits[-7:] if 7 <= len(digits) <= 13 or piece.startswith("+") else digits


def _features(text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    f = np.zeros(N_FEATURES)
    piece = text[start:end]
    digits = _NOT_DIGIT.sub("", piece)
    n = len(digits)
    f[0] = 1
    f[1 + min(n // 4, 5)] = 1
    f[7] = " " in piece
    f[8] = "-" in piece
    f[9] = "(" in piece
    f[10] = piece.count(".") == 3
    f[11] = bool(re.search("[A-Za-z]", piece))
    before = re.findall(r"[a-z-]+", text[max(0, start - 24):start].lower())
    for w in before[-2:]:
        if w in _CUES:
            f[12 + _CUES[w]] = 1
    f[16] = text[start - 1:start].isalnum() or text[end:end + 1].isalnum()
    hidden = f.copy()
    f[17] = piece.startswith("+")
    f[18] = "@" in piece and "." in piece.rpartition("@")[2]
    f[19] = 14 <= n <= 19 and luhn(digits)
    f[20] = piece.count(".") == 3 and all(p.isdigit() and _small(p) for p in piece.split("."))
    return f, hidden


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _ADDRESS.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
        done = m.end()


def _free(taken: list[tuple[int, int]]):
    """Whether a stretch meets none of the taken ones, by search in their union."""
    starts, ends = [], []
    for a, b in sorted(taken):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a), ends.append(b)
    return lambda a, b: bisect.bisect_right(ends, a) == bisect.bisect_left(starts, b)


def nodes(text: str, base: list[tuple[int, int, int]]) -> list[Node]:
    found = [(a, b, k) for a, k, b in base]
    if _MAYBE.search(text) or "at" in text:
        free = _free([(a, b) for a, b, _ in found])
        open_ = list(_addresses(text)) if "@" in text or "at)" in text or "at]" in text else []
        open_ += [m.span() for m in _NUMBER.finditer(text) if 7 <= len(_NOT_DIGIT.sub("", m.group())) <= 19]
        last = -1
        for a, b in sorted(open_):
            if a >= last and free(a, b):
                found.append((a, b, -1))
                last = b
    out = []
    for a, b, k in sorted(found):
        f, hidden = _features(text, a, b)
        out.append(Node(a, b, k, _key(text[a:b]), f, hidden))
    return out


def edges(ns: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between near neighbours, skip edges between consecutive nodes with
    the same key."""
    chain = [(k, k + 1) for k in range(len(ns) - 1) if ns[k + 1].start - ns[k].end <= NEAR]
    last: dict[str, int] = {}
    skip = []
    for k, n in enumerate(ns):
        if n.key in last:
            skip.append((last[n.key], k))
        last[n.key] = k
    return chain, skip


# -- field -----------------------------------------------------------------------

@dataclass
class Weights:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray


def prior() -> Weights:
    unary = np.zeros((N_FEATURES, OTHER + 1))
    unary[0, OTHER] = 1.0
    for label, f in enumerate((18, 20, 19, 17)):
        unary[f, label] = 3.0
    return Weights(unary, np.zeros((OTHER + 1, OTHER + 1)), 4.0 * np.eye(OTHER + 1))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def examples(text: str) -> Iterator[tuple[int, ...]]:
    """A row of small whole numbers for each labelled node of one text: features, label,
    neighbours by label along chain and skip edges."""
    ns = nodes(text, base_spans(text))
    known: dict[str, int] = {}
    for n in ns:
        if n.label >= 0:
            known[n.key] = n.label if known.get(n.key, n.label) == n.label else -1
    label = [n.label if n.label >= 0 else known.get(n.key, OTHER) for n in ns]
    near = [np.zeros((2, OTHER + 1)) for _ in ns]
    for which, es in enumerate(edges(ns)):
        for a, b in es:
            for p, q in ((a, b), (b, a)):
                if label[q] >= 0:
                    near[p][which][label[q]] += 1
    for n, own, around in zip(ns, label, near, strict=True):
        for f in ((n.features, n.hidden) if n.label >= 0 and around[1].any() else (n.features,)) if own >= 0 else ():
            yield tuple(int(v) for v in (*f, own, *around[0], *around[1]))


def fit(texts: list[str], steps: int = 150, rate: float = 1.0, pull: float = 1e-3) -> Weights:
    return fit_counted(Counter(e for text in texts for e in examples(text)), steps, rate, pull)


def fit_counted(counts: dict[tuple[int, ...], int], steps: int = 150, rate: float = 1.0, pull: float = 1e-3) -> Weights:
    """Pseudo-likelihood with the neighbours' labels given, pulled towards the prior, from
    distinct examples and how often each occurs."""
    w, start = prior(), prior()
    rows = np.array(sorted(counts), dtype=float).reshape(len(counts), -1)
    if not counts or (rows[:, N_FEATURES] == OTHER).all():
        return w
    often = np.array([counts[k] for k in sorted(counts)], dtype=float)
    x, y, c, s = rows[:, :N_FEATURES], rows[:, N_FEATURES].astype(int), rows[:, N_FEATURES + 1:-OTHER - 1], rows[:, -OTHER - 1:]
    t = np.eye(OTHER + 1)[y]
    # every kind counts alike, however rare
    weight = often * (1 / np.maximum(often @ t, 1))[y]
    weight = (weight / weight.sum())[:, None]
    for _ in range(steps):
        off = weight * (t - _softmax(x @ w.unary + c @ w.chain + s @ w.skip))
        w.unary += rate * (x.T @ off - pull * (w.unary - start.unary))
        for m, z, at in ((w.chain, c, start.chain), (w.skip, s, start.skip)):
            g = z.T @ off
            m += rate * ((g + g.T) / 2 - pull * (m - at))
    return w


def marginals(ns: list[Node], w: Weights, rounds: int = ROUNDS) -> np.ndarray:
    """Loopy sum-product; given labels are clamped."""
    local = np.array([n.features for n in ns]) @ w.unary
    for k, n in enumerate(ns):
        if n.label >= 0:
            local[k] = -50.0
            local[k, n.label] = 0.0
    chain, skip = edges(ns)
    both = chain + skip
    if not both:
        return _softmax(local)
    a = np.array([e[0] for e in both] + [e[1] for e in both])
    b = np.array([e[1] for e in both] + [e[0] for e in both])
    potential = np.concatenate([np.repeat(w.chain[None], len(chain), 0), np.repeat(w.skip[None], len(skip), 0)] * 2)
    back = np.concatenate([np.arange(len(both), 2 * len(both)), np.arange(len(both))])
    sent = np.zeros((len(a), OTHER + 1))  # log messages a -> b
    for _ in range(rounds):
        belief = local.copy()
        np.add.at(belief, b, sent)
        out = (belief[a] - sent[back])[:, :, None] + potential
        top = out.max(axis=1, keepdims=True)
        sent = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        sent -= sent.max(axis=1, keepdims=True)
    belief = local.copy()
    np.add.at(belief, b, sent)
    return _softmax(belief)


def find(text: str, w: Weights) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added spans as (start, kind number, end)."""
    base = base_spans(text)
    ns = nodes(text, base)
    if all(n.label >= 0 for n in ns):
        return base, []
    p = marginals(ns, w)
    best = p.argmax(axis=1)
    return base, [(n.start, int(k), n.end) for n, k, q in zip(ns, best, p, strict=True) if n.label < 0 and k != OTHER and q[k] >= SURE]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = Counter(e for text in batch.column("text") for e in examples(text.as_py()))
        yield pa.RecordBatch.from_arrays([pa.array([list(e) for e in found], pa.list_(pa.int32())),
                                          pa.array(list(found.values()), pa.int64())], names=["example", "n"])


def train(docs: DataFrame, sample: int = SAMPLE) -> Weights:
    """Fits on the ``sample`` distinct texts with the smallest hashes. A bound on the hash lets
    about twice as many through, so tasks send no more hashes to the driver, however many
    they are. The texts stay in the tasks."""
    shipped(docs.sparkSession)
    texts = docs.select("text", F.xxhash64("text").alias("h")).filter(F.col("text").rlike("[0-9@]"))
    n = texts.agg(F.approx_count_distinct("h")).first()[0]
    most = -2**63 + int(2**64 * 2 * sample / max(n, 2 * sample)) - 1
    hashes = [r["h"] for r in texts.filter(F.col("h") <= most).select("h").distinct().orderBy("h").limit(sample).collect()]
    if not hashes:
        return prior()
    picked = texts.filter(F.col("h") <= hashes[-1]).groupBy("h").agg(F.min("text").alias("text")).select("text")
    counted = picked.mapInArrow(_examples, "example array<int>, n long").groupBy("example").agg(F.sum("n").alias("n"))
    return fit_counted({tuple(r["example"]): r["n"] for r in counted.collect()})


def personal_data(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans, n_added."""
    shipped(docs.sparkSession)
    w = weights or train(docs)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, added = [[] for _ in KINDS], [], [], []
            for text in batch.column("text"):
                base, more = find(text.as_py(), w)
                for k, c in enumerate(counts):
                    c.append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(sorted(base + more)))
                added.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return d.mapInArrow(each, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))
