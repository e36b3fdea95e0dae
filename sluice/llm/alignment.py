"""Cross-tokenizer alignment by diagonal run skipping.

A text is read by two tokenizers: tokens A of space + text by a byte-level vocabulary,
tokens B of the text by a piece vocabulary, which puts the space in front itself. Byte
offsets where tokens of both end cut them into groups; the last tokens of a group are
linked (no token of either vocabulary is empty, so these are all pairs that end together).

``i`` and ``j = i + shift`` run over the two arrays of ends. On a diagonal, where the ends
are equal at the current shift, blocks of 1, 2, 4 ... ends are compared at once; the first
block that differs is halved again, so a one-to-one stretch of n tokens costs about
2 log n comparisons of slices. Between stretches the smaller end moves on until both meet;
that group gives the next shift. Long texts are aligned in windows of ``WINDOW`` bytes
that begin at a common end.

Pair counts: linked tokens end together, so the shorter one's bytes are a suffix of the
longer one's. There are thus at most as many id pairs as the two vocabularies have token
bytes (about 600,000), however large the corpus is; this table alone goes to all tasks.

Defined cases: a null or empty text, and one whose joined A or B bytes are not those of
space + text (e.g. texts with U+2581), has no tokens: zeros and an empty digest. Strings
of special tokens inside texts are plain text. Repeated rows and rows with null ids are
documents of their own, each counted. Ties: a link counts as best if its count equals the
highest of its B id. Texts of any length are read whole. Extra columns are ignored,
whatever their names; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import checkpoint_path

from . import packing
from .common import documents, shipped

A_RANKS, B_MODEL = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Bytes of text aligned at a time.
WINDOW = 1 << 18
#: Links counted together, and bytes of links in one batch.
TALLY, FLUSH_BYTES = 8_000_000, 4 << 20


class PairTexts(dict):
    """``a|b`` of each linked pair met so far (at most one for a pair that can be linked)."""

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, pair: int) -> str:
        self[pair] = text = "%d|%d" % divmod(pair, self.size)
        return text


class Vocabularies:
    """The bytes, lengths and decimal forms of the tokens of both vocabularies."""

    def __init__(self, a_ranks: str | None, b_model: str | None):
        import public_tokenizers
        import sentencepiece
        ranks = packing._encoder(a_ranks or public_tokenizers.path(A_RANKS))
        self.ranks, self.pieces = ranks, sentencepiece.SentencePieceProcessor(model_file=b_model or public_tokenizers.path(B_MODEL))
        a_bytes = {ranks.encode_single_token(x): x for x in ranks.token_byte_values()}
        sp = self.pieces
        # control and unknown pieces stand for no bytes; encoding gives none of them for a text that it can spell
        self.b_bytes = [bytes([int(sp.id_to_piece(k)[3:-1], 16)]) if sp.is_byte(k)
                        else b"" if sp.is_control(k) or sp.is_unknown(k)
                        else sp.id_to_piece(k).replace("▁", " ").encode() for k in range(sp.get_piece_size())]
        self.a_length = np.array([len(a_bytes.get(k, b"")) for k in range(max(a_bytes) + 1)], dtype=np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_size, self.b_size = len(self.a_length), len(self.b_length)
        self.texts = PairTexts(self.b_size)
        self.a_text, self.b_text = ([str(k) for k in range(size)] for size in (self.a_size, self.b_size))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both; none if either does not spell space + text."""
        none = np.empty(0, dtype=np.int64)
        if not text:
            return none, none
        whole = (" " + text).encode()
        b = self.pieces.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return none, none
        # the rank file's reader cuts the bytes themselves, so its tokens always spell the text
        a = packing.token_ids("", " " + text)[:-1] if packing._long_space(text) else self.ranks.encode_to_numpy(" " + text)
        return a.astype(np.int64), np.array(b, dtype=np.int64)


@lru_cache(maxsize=2)
def vocabularies(a_ranks: str | None = None, b_model: str | None = None) -> Vocabularies:
    return Vocabularies(a_ranks, b_model)


def runs(a: list[int], b: list[int]) -> np.ndarray:
    """The groups of two ascending lists of ends, as rows (i, i_end, j, j_end): a stretch of
    n one-to-one groups is one row (i, i + n, j, j + n); any other group is a row of its own,
    with a side longer than one and ends that first differ. What follows the last common
    end is left out."""
    i, j, n, m, out = 0, 0, len(a), len(b), []
    a.append(-1), b.append(-2)  # no block that goes beyond the ends is equal
    while i < n and j < m:
        x, y = a[i], b[j]
        first_i, first_j = i, j
        if x == y:
            shift = j - i
            i += 1
            if a[i] == b[i + shift]:
                i += 1
                step = 2
                while a[i:i + step] == b[i + shift:i + shift + step]:
                    i += step
                    step += step
                while step > 1:  # a block that differs: halve it up to the first differing end
                    step >>= 1
                    if a[i:i + step] == b[i + shift:i + shift + step]:
                        i += step
            j = i + shift
        else:
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                    if x < 0:
                        return np.array(out, dtype=np.int64).reshape(-1, 4)
                else:
                    j += 1
                    y = b[j]
                    if y < 0:
                        return np.array(out, dtype=np.int64).reshape(-1, 4)
            i += 1
            j += 1
        out += (first_i, i, first_j, j)
    return np.array(out, dtype=np.int64).reshape(-1, 4)


def aligned(a_ids: np.ndarray, b_ids: np.ndarray, v: Vocabularies, window: int = WINDOW) -> tuple[int, str, np.ndarray]:
    """Number of groups, their digest and the linked pairs (a * size of B + b) of one text."""
    if not len(a_ids):
        return 0, "", np.empty(0, dtype=np.int64)
    a_ends, b_ends = np.cumsum(v.a_length[a_ids]), np.cumsum(v.b_length[b_ids])
    digest, groups, links = hashlib.sha256(), 0, []
    i0 = j0 = start = 0
    wide = window
    while i0 < len(a_ids):
        i1, j1 = int(np.searchsorted(a_ends, start + wide, "right")), int(np.searchsorted(b_ends, start + wide, "right"))
        rows = runs(a_ends[i0:i1].tolist(), b_ends[j0:j1].tolist())
        if not len(rows):  # no common end within the window
            wide *= 2
            continue
        i, i_end, j, j_end = rows.T
        stretch = a_ends[i0 + i] == b_ends[j0 + j]
        number = np.where(stretch, i_end - i, 1)
        behind = np.cumsum(number)
        back = np.repeat(behind, number) - np.arange(behind[-1])  # 1 for the last group of a stretch
        own = a_ids[i0 + np.repeat(i_end, number) - back] * v.b_size + b_ids[j0 + np.repeat(j_end, number) - back]
        parts = list(map(v.texts.__getitem__, own.tolist()))
        a_list, b_list, a_text, b_text = a_ids[i0:i1].tolist(), b_ids[j0:j1].tolist(), v.a_text.__getitem__, v.b_text.__getitem__
        for at, (x, x_end, y, y_end) in zip((behind[~stretch] - 1).tolist(), rows[~stretch].tolist(), strict=True):
            parts[at] = ",".join(map(a_text, a_list[x:x_end])) + "|" + ",".join(map(b_text, b_list[y:y_end]))
        digest.update(((";" if groups else "") + ";".join(parts)).encode())
        groups += len(parts)
        links.append(own)
        i0, j0, wide = i0 + int(i_end[-1]), j0 + int(j_end[-1]), window
        start = int(a_ends[i0 - 1])
    return groups, digest.hexdigest(), np.concatenate(links)


_FIRST = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"


def _align(a_ranks: str | None, b_model: str | None):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(a_ranks, b_model)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in _FIRST.split(", ")]
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                a, b = v.encode(text.as_py())
                groups, digest, links = aligned(a, b, v)
                raw = links.astype(_link_type(v)).tobytes()
                rows.append((doc, len(a), len(b), groups, digest, raw))
                held += len(raw) + 100
                if held > FLUSH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    return align


def _link_type(v: Vocabularies) -> str:
    return "<u4" if v.a_size * v.b_size < 2**32 else "<u8"


def _tally(a_ranks: str | None, b_model: str | None):
    """Counts of the pairs within each TALLY links."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _link_type(vocabularies(a_ranks, b_model))
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

        for batch in batches:
            for raw in batch.column("links"):
                held.append(np.frombuffer(raw.as_py(), dtype=kind))
                size += len(held[-1])
                if size > TALLY:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()
    return tally


def _scored(pair: bytes, n: bytes, best: bytes, a_ranks: str | None, b_model: str | None):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _link_type(vocabularies(a_ranks, b_model))
        pairs, counts, is_best = np.frombuffer(pair, dtype=np.int64).astype(kind), np.frombuffer(n, dtype=np.int64), np.frombuffer(best, dtype=bool)
        for batch in batches:
            at = [np.searchsorted(pairs, np.frombuffer(raw.as_py(), dtype=kind)) for raw in batch.column("links")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")),
                 pa.array([len(x) for x in at], pa.int64()), pa.array([int(is_best[x].sum()) for x in at], pa.int64()),
                 pa.array([int(counts[x].sum()) for x in at], pa.int64()), batch.column("groups_sha256")], names=_RESULT)
    return scored


_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def pair_counts(first: DataFrame, a_ranks: str | None = None, b_model: str | None = None) -> DataFrame:
    """pair, n, best for every linked id pair of the corpus; the pair is a * size of B + b."""
    size = vocabularies(a_ranks, b_model).b_size
    counts = first.select("links").mapInArrow(_tally(a_ranks, b_model), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")) \
        .withColumn("b", F.col("pair") % size)
    return counts.join(counts.groupBy("b").agg(F.max("n").alias("most")), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_ranks: str | None = None, b_model: str | None = None) -> DataFrame:
    """One row per document with the columns of ``_RESULT``. ``a_ranks``, ``b_model``:
    vocabulary files, opened where the texts are read (None: the public ones)."""
    spark = docs.sparkSession
    shipped(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    path = checkpoint_path(spark, "llm", f"alignments-{uuid.uuid4().hex}")
    d.mapInArrow(_align(a_ranks, b_model), _FIRST).write.option("compression", "zstd").parquet(path)
    first = spark.read.schema(_FIRST).parquet(path)
    t = pair_counts(first, a_ranks, b_model).orderBy("pair").toArrow()
    column = lambda c, kind: t.column(c).to_numpy().astype(kind).tobytes()
    return first.mapInArrow(_scored(column("pair", np.int64), column("n", np.int64), column("best", bool), a_ranks, b_model),
                            "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
