"""Spelling variant grouping: k-d trees over letter-count vectors.

Words are the maximal runs of Latin letters, A-Z lower-cased; the run of a document whose
keyed checksum 97 divides loses one code point (so that the corpus holds known variants).
Two words are near if one inserted, deleted or replaced code point tells them apart. Then
their vectors of letter counts differ by one letter more on one side (lengths differ by
one) or by one letter more on either side (equal lengths): an L1 distance of one or two.

For each length there is one k-d tree; it holds the words of that length, and is searched
with the words of that length and of one letter less. A search goes down both sides of a
cut as long as the box behind it can be reached: the letters that a point in the box has
more (``up``), and those that it has less (``down``), are summed over the cuts passed, and
the search ends where either exceeds what the pair of lengths allows. What is found is
verified on the order of the letters.

* The upper part of the trees is made on the driver and deals the words out: a word is a
  point of one leaf and a query of each leaf that it can reach. Its cuts are fitted to a
  sample of the words by hash, ``PER_LEAF`` for each leaf of about ``PART`` words and at
  most ``MOST_SAMPLED`` in all (the documented bound). All words are indexed, and no
  result depends on the sample: recall is 1. A leaf of more than ``HOT`` words (the same
  letters again and again) is dealt out in chunks, which its queries visit all.
* Each leaf is one group of a Spark shuffle; a task builds the lower part of the tree and
  searches it with blocks of queries. Anagrams share one vector; where two anagram classes
  would give more than ``MANY`` pairs, the words one edit away are looked up instead.
* Only a word's count of near words and its best one leave a leaf, never pairs.

A form has at least twice the count of its word, so chains have at most 62 steps; roots
are found by doubling self-joins.

Defined cases: null and empty texts have no words; a null id is written as the empty
string before the colon; repeated rows count each time; ties between forms go to the
smallest word in code-point order; runs of any length are words; an empty table gives no
rows. Extra columns are ignored, whatever their names.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, shipped, written

#: Every run whose checksum this divides loses a code point.
EDITED = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Distinct words that a task counts together.
COUNTED = 500_000
#: Words of a leaf of the upper tree, sampled words for each, and the most sampled.
PART, PER_LEAF, MOST_SAMPLED = 8_000, 64, 500_000
HOT = 4 * PART
#: Vectors of a leaf of the lower tree, queries searched together, elements of one comparison.
LEAF, QUERIES, BLOCK = 16, 50_000, 4_000_000
MANY = 4096

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Letters by their code: a-z, then U+00C0 to U+00FF.
_LETTER = np.zeros(256, dtype=np.int64)
_LETTER[97:123], _LETTER[192:256] = range(26), range(26, 90)
LETTERS = 90


# -- words -----------------------------------------------------------------------

def runs_of(doc_id: int | None, text: str | None) -> Iterator[tuple[str, int]]:
    """The words of one text, with their number."""
    text = text or ""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(RUN.findall(text.lower() if text.isascii() else text.translate(_LOWER))).items():
        if len(word) >= LEAST_LENGTH:
            h = zlib.crc32(word.encode(), start)
            if h % EDITED == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            yield word, n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            for word, n in runs_of(doc, text.as_py()):
                counts[word] += n
            if len(counts) > COUNTED:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: the words of the corpus."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return d.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


# -- k-d trees ---------------------------------------------------------------------

def letters(words: list[str], length: int) -> np.ndarray:
    """The words of one length as a matrix of codes."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), length)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts of each row."""
    rows, length = codes.shape
    kind = np.uint8 if length < 256 else np.int32
    out = np.empty((rows, LETTERS), dtype=kind)
    step = max(1, BLOCK // max(LETTERS, length))
    for k in range(0, rows, step):
        part = _LETTER[codes[k:k + step]] + np.arange(min(step, rows - k))[:, None] * LETTERS
        out[k:k + step] = np.bincount(part.ravel(), minlength=min(step, rows - k) * LETTERS).reshape(-1, LETTERS)
    return out


class Tree:
    """Cuts: letter, highest count of the left side, and the box's least and highest count
    of that letter. A node that is no cut is a leaf (``leaf`` >= 0)."""

    def __init__(self, points: np.ndarray, most: int):
        self.cuts: list[tuple[int, int, int, int, int, int]] = []  # letter, cut, lo, hi, left, right
        self.leaf: list[int] = []
        self.held: list[np.ndarray] = []  # the points of each leaf
        waiting = [(np.arange(len(points)), {}, None)]
        while waiting:
            at, box, parent = waiting.pop()
            node = len(self.leaf)
            if parent is not None:
                cut = list(self.cuts[parent[0]])
                cut[4 + parent[1]] = node
                self.cuts[parent[0]] = tuple(cut)
            best = self._cut(points[at]) if len(at) > most else None
            if best is None:
                self.leaf.append(len(self.held))
                self.cuts.append((0, 0, 0, 0, 0, 0))
                self.held.append(at)
                continue
            d, t = best
            lo, hi = box.get(d, (0, 1 << 30))
            self.leaf.append(-1)
            self.cuts.append((d, t, lo, hi, 0, 0))
            left = points[at, d] <= t
            waiting.append((at[left], {**box, d: (lo, t)}, (node, 0)))
            waiting.append((at[~left], {**box, d: (t + 1, hi)}, (node, 1)))

    @staticmethod
    def _cut(points: np.ndarray) -> tuple[int, int] | None:
        """The most even cut; None if the points are equal."""
        best, n = (0, 0, 0), len(points)
        tries = np.unique(np.concatenate([np.arange(4), np.median(points, axis=0).astype(np.int64), points.max(axis=0).astype(np.int64) - 1]))
        for t in tries[(tries >= 0) & (tries < points.max(initial=0))][:64].tolist():
            low = (points <= t).sum(axis=0)
            even = np.minimum(low, n - low)
            d = int(even.argmax())
            best = max(best, (int(even[d]), -d, -t))
        return (-best[1], -best[2]) if best[0] else None

    def reached(self, q: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of q that may be near a point in it): a point may have at most
        ``up`` letters more and ``down`` letters less than a query."""
        zero = np.zeros(len(q), dtype=np.int32)
        waiting = [(0, np.arange(len(q)), zero, zero)]
        while waiting:
            node, at, ups, downs = waiting.pop()
            if self.leaf[node] >= 0:
                yield self.leaf[node], at
                continue
            d, t, lo, hi, left, right = self.cuts[node]
            x = q[at, d].astype(np.int32)
            less = downs + np.maximum(x - t, 0) - np.maximum(x - hi, 0)
            more = ups + np.maximum(t + 1 - x, 0) - np.maximum(lo - x, 0)
            go = less <= down
            if go.any():
                waiting.append((left, at[go], ups[go], less[go]))
            go = more <= up
            if go.any():
                waiting.append((right, at[go], more[go], downs[go]))


# -- one leaf ----------------------------------------------------------------------

def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: is b (of equal length, or one longer) one edit away from a?"""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    before = np.cumprod(a == b[:, :-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return before + behind >= a.shape[1]


class Classes:
    """Words of one length by their letters: anagrams are one class with one vector."""

    def __init__(self, words: list[str]):
        self.words, self.codes = words, letters(words, len(words[0]))
        self.vectors, self.of = np.unique(vectors(self.codes), axis=0, return_inverse=True)
        self.of = self.of.ravel()
        self.order = np.argsort(self.of, kind="stable")
        self.first = np.searchsorted(self.of[self.order], np.arange(len(self.vectors) + 1))


def near_classes(points: Classes, tree: Tree, queries: Classes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (query class, point class) whose vectors are one edit apart."""
    same = points.codes.shape[1] == queries.codes.shape[1]
    used = np.flatnonzero(points.vectors.any(axis=0) | queries.vectors.any(axis=0))  # letters that occur
    p, wide = points.vectors[:, used], queries.vectors
    for k in range(0, len(wide), QUERIES):
        for leaf, at in tree.reached(wide[k:k + QUERIES], 1, int(same)):
            here = tree.held[leaf]
            own = p[here].astype(np.int32)
            step = max(1, BLOCK // (len(here) * len(used)))
            for j in range(0, len(at), step):
                q = wide[k:k + QUERIES][at[j:j + step]][:, used].astype(np.int32)
                apart = np.abs(q[:, None, :] - own[None, :, :]).sum(axis=2)
                x, y = np.nonzero(apart == (2 if same else 1))
                if len(x):
                    yield at[j:j + step][x] + k, here[y]


def near_words(points: Classes, queries: Classes, pairs: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (query word, point word) that are one edit apart, from a block of class pairs."""
    x, y = pairs
    nx, ny = (np.diff(c.first)[k] for c, k in ((queries, x), (points, y)))
    many = nx * ny > MANY
    for i, j in zip(x[many].tolist(), y[many].tolist(), strict=True):
        yield _looked_up(points, queries, i, j)
    x, y, nx, ny = x[~many], y[~many], nx[~many], ny[~many]
    block = max(MANY, BLOCK // points.codes.shape[1])
    sizes = np.cumsum(nx * ny)
    start = 0
    while start < len(x):
        end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + block, "right")))
        n = nx[start:end] * ny[start:end]
        which = np.repeat(np.arange(start, end), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        a = queries.order[queries.first[x[which]] + k // ny[which]]
        b = points.order[points.first[y[which]] + k % ny[which]]
        near = one_edit(queries.codes[a], points.codes[b])
        yield a[near], b[near]
        start = end


def _looked_up(points: Classes, queries: Classes, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Two large classes: the words one edit away from each query word are looked up."""
    more, less = points.vectors[j].astype(np.int64), queries.vectors[i].astype(np.int64)
    letter = lambda d: chr(d + 97 if d < 26 else d + 166)
    gained = letter(int((more - less).argmax()))
    lost = letter(int((less - more).argmax())) if (less > more).any() else ""
    there = {points.words[k]: k for k in points.order[points.first[j]:points.first[j + 1]].tolist()}
    a, b = [], []
    for k in queries.order[queries.first[i]:queries.first[i + 1]].tolist():
        w = queries.words[k]
        found = {there.get(w[:c] + gained + w[c + len(lost):]) for c in range(len(w) + (not lost)) if not lost or w[c] == lost}
        for m in found - {None}:
            a.append(k), b.append(m)
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


class _Best:
    """Number of near words and the best near word of each word of one list."""

    def __init__(self, words: list[str]):
        self.words, self.n_near = words, np.zeros(len(words), dtype=np.int64)
        self.n, self.rank = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)

    def add(self, at: np.ndarray, n: np.ndarray, rank: np.ndarray) -> None:
        """n, rank: counts of the near words and their places in code-point order."""
        if not len(at):
            return
        self.n_near += np.bincount(at, minlength=len(self.words))
        best = np.lexsort((rank, -n, at))
        best = best[np.r_[True, np.diff(at[best]) > 0]]
        at, n, rank = at[best], n[best], rank[best]
        better = (n > self.n[at]) | ((n == self.n[at]) & (rank < self.rank[at]))
        self.n[at[better]], self.rank[at[better]] = n[better], rank[better]


_NEAR = "word string, n_near long, best_n long, best string"


def _search(group: pa.Table) -> pa.Table:
    """All near words between a leaf's points and its queries. role 0: points, which
    search their own leaf too, 1: queries of equal length, 2: queries one letter shorter."""
    role, words, n = (np.array(group.column(c).to_pylist(), dtype=object if c == "word" else np.int64) for c in ("role", "word", "n"))
    of = lambda k: np.flatnonzero(role <= 1) if k == 1 else np.flatnonzero(role == k)
    order = np.argsort(words, kind="stable")
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    out = []
    if len(p := of(0)):
        points, found = Classes(words[p].tolist()), _Best(words[p].tolist())
        tree = Tree(points.vectors, LEAF)
        for kind in (1, 2):
            if not len(q := of(kind)):
                continue
            queries, own = Classes(words[q].tolist()), _Best(words[q].tolist())
            for pairs in near_classes(points, tree, queries):
                for a, b in near_words(points, queries, pairs):
                    own.add(a, n[p][b], rank[p][b])
                    if kind == 2:
                        found.add(b, n[q][a], rank[q][a])
            out.append(own)
        out.append(found)
    rows = [[], [], [], []]
    for best in out:
        for k in np.flatnonzero(best.n_near).tolist():
            for col, v in zip(rows, (best.words[k], int(best.n_near[k]), int(best.n[k]), words[order[best.rank[k]]]), strict=True):
                col.append(v)
    return pa.table([pa.array(c, t) for c, t in zip(rows, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                    names=["word", "n_near", "best_n", "best"])


# -- all leaves --------------------------------------------------------------------

def upper_trees(words: DataFrame, n_words: int) -> dict[int, Tree]:
    """A tree for each length with more than PER_LEAF sampled words; other lengths are one leaf."""
    rate = max(1, PART // PER_LEAF, -(-n_words // MOST_SAMPLED))
    chosen = words.filter(F.pmod(F.xxhash64("word"), F.lit(rate)) == 0).select("word").limit(2 * MOST_SAMPLED).toArrow().column(0).to_pylist()
    by_length: dict[int, list[str]] = {}
    for w in chosen:
        by_length.setdefault(len(w), []).append(w)
    trees = {k: Tree(vectors(letters(sorted(ws), k)), PER_LEAF) for k, ws in by_length.items() if len(ws) > PER_LEAF}
    for t in trees.values():
        t.held = []
    return trees


def _deal(trees: dict[int, Tree], chunks: dict[tuple[int, int], int], points_only: bool):
    """Rows (size, leaf, chunk, role, word, n) of each word."""
    names = ["size", "leaf", "chunk", "role", "word", "n"]

    def rows(size: int, leaf: int, role: int, words: list[str], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        k = chunks.get((size, leaf), 1)
        own = np.array([zlib.crc32(w.encode()) % k for w in words]) if k > 1 else np.zeros(len(words), dtype=np.int64)
        for chunk in range(1 if role == 0 and k == 1 else k):
            kind = np.where(own == chunk, 0, 1) if role == 0 else np.full(len(words), role)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), x), pa.int64()) for x in (size, leaf, chunk)]
                                             + [pa.array(kind, pa.int64()), pa.array(words, pa.string()), pa.array(n, pa.int64())], names=names)

    def of_length(size: int, words: list[str], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        v = vectors(letters(words, size))
        home = np.zeros(len(words), dtype=np.int64)
        if size in trees:
            for leaf, at in trees[size].reached(v, 0, 0):
                home[at] = leaf
        for leaf in np.unique(home).tolist():
            at = np.flatnonzero(home == leaf)
            yield from rows(size, leaf, 0, [words[k] for k in at.tolist()], n[at])
        if points_only:
            return
        for longer in (0, 1):
            tree = trees.get(size + longer)
            for leaf, at in tree.reached(v, 1, 1 - longer) if tree else [(0, np.arange(len(words)))]:
                at = at if longer else at[home[at] != leaf]
                if len(at):
                    yield from rows(size + longer, leaf, 1 + longer, [words[k] for k in at.tolist()], n[at])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            sizes = np.array([len(w) for w in words], dtype=np.int64)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                yield from of_length(size, [words[k] for k in at.tolist()], n[at])
    return deal


_DEALT = "size long, leaf long, chunk long, role long, word string, n long"


def near_counts(words: DataFrame) -> DataFrame:
    """word, n_near, best (struct of minus the count and the word) of every word that has
    a near one. ``words``: a written table of distinct words and their counts."""
    shipped(words.sparkSession)
    trees = upper_trees(words, words.count())
    points = words.mapInArrow(_deal(trees, {}, True), _DEALT).groupBy("size", "leaf").count().filter(F.col("count") > HOT).collect()
    chunks = {(r["size"], r["leaf"]): -(-r["count"] // PART) for r in points}  # at most one row for HOT words
    dealt = words.mapInArrow(_deal(trees, chunks, False), _DEALT)
    found = dealt.groupBy("size", "leaf", "chunk").applyInArrow(_search, _NEAR)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("form"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the ends of the chains of ``forms`` (word, form), by doubling."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_forms(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the corpus."""
    shipped(docs.sparkSession)
    words = written(word_counts(docs), "words")
    near = words.join(near_counts(words), "word", "left")
    count = -F.col("best")["minus"]
    has_form = count >= 2 * F.col("n")
    near = written(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(has_form, F.col("best")["form"]).alias("form"), F.when(has_form, count).alias("form_n")), "near-words")
    ends = roots(near.filter(F.col("form").isNotNull()))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(documents(spark, sf_dir))
