"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The agenda holds all merges of neighbouring symbols that the model knows; the one
with the best score (then the leftmost) is applied, until none is left. With dropout,
a candidate merge is skipped if a hash keyed by seed, document, the segment's place
in the document, place in the segment and the two symbols falls below the rate, so
the same seed always gives the same segmentation and other seeds, documents and places
give others, each with the rate of its own. Skipped merges only leave smaller pieces,
so every segmentation decodes to the same text.

Merges never cross a word start (no piece of the model has its space mark behind
another character) or a character without a piece, so a text falls into segments.
Equal segments are encoded once per block without dropout. An occurrence for which
none of the merges met there is skipped has that encoding; every other occurrence is
encoded by itself. All these segments advance together, one merge a round.

Characters without a piece, and the space mark itself when a text contains it, become
byte pieces. Defined cases: a null or empty text has no ids and decodes to the empty
text; rows with equal ids and texts get equal ids; an empty table gives no rows. Extra
columns are ignored.
"""
from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, shipped, text_or_empty

SEED = 20240201
RATE = 0.1
MARK = "▁"
BLOCK_CHARS = 2 << 20
#: Longer segments are encoded one by one with a heap.
LONG = 256
#: Occurrences looked at together for skips.
SHARE_ROWS = 50_000
TABLE_BITS = 20
NEVER = np.int32(2**31 - 1)

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Model:
    """Pieces, merges and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        plain = {p: i for i, p in enumerate(pieces) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.bytes = np.zeros(256, dtype=np.int32)
        self.text = [b""] * self.size
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
                self.text[i] = bytes([int(p[3:5], 16)])
        for p, i in plain.items():
            self.text[i] = p.replace(MARK, " ").encode()
        assert not any(MARK in p.lstrip(MARK) for p in plain), "merges would cross word starts"
        self.char = np.full(0x110000, -1, dtype=np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.mark = int(self.char[ord(MARK)])
        order = {i: r for r, i in enumerate(sorted((i for p, i in plain.items() if len(p) > 1), key=lambda i: (-sp.get_score(i), i)))}
        found = sorted((plain[p[:k]] * self.size + plain[p[k:]], i) for p, i in plain.items() for k in range(1, len(p))
                       if p[:k] in plain and p[k:] in plain)
        self.keys = np.array([k for k, _ in found], dtype=np.int64)
        # open addressing, sparsely filled; the last row stands for "no merge"
        self.merged = np.array([i for _, i in found] + [0], dtype=np.int32)
        self.rank = np.array([order[i] for _, i in found] + [NEVER], dtype=np.int32)
        self.slots = np.full(1 << TABLE_BITS, -1, dtype=np.int64)
        self.rows = np.full(1 << TABLE_BITS, len(found), dtype=np.int32)
        for row, k in enumerate(self.keys.tolist()):
            at = (k * int(_A) % 2**64) >> (64 - TABLE_BITS)
            while self.slots[at] >= 0:
                at = (at + 1) % (1 << TABLE_BITS)
            self.slots[at], self.rows[at] = k, row

    def merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER: none) and merged id of neighbouring symbols."""
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = -1
        at = ((key.view(np.uint64) * _A) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        there = self.slots[at]
        row = np.where(there == key, self.rows[at], len(self.merged) - 1)
        off = np.flatnonzero((there != key) & (there >= 0))
        while len(off):
            at[off] = (at[off] + 1) % (1 << TABLE_BITS)
            there = self.slots[at[off]]
            row[off[there == key[off]]] = self.rows[at[off[there == key[off]]]]
            off = off[(there != key[off]) & (there >= 0)]
        return self.rank[row], self.merged[row]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def skipped(key, place, left, right, rate: float):
    """Is this candidate merge dropped? (arrays or numbers; ``key``: of the seed and
    the segment's occurrence)"""
    with np.errstate(over="ignore"):
        u = lambda x: np.asarray(x).astype(np.uint64)
        h = _mixed(u(key) + u(place) * _B + u(left) * _C + u(right) * _A)
    return (h >> np.uint64(11)).astype(np.float64) < rate * 2.0**53


def agenda(m: Model, symbols: list[int], key: np.uint64, rate: float) -> list[int]:
    """One segment by a heap."""
    n = len(symbols)
    sym, nxt, prev, alive = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(ks: list[int]) -> None:
        ks = [k for k in ks if k >= 0 and nxt[k] < n]
        if not ks:
            return
        left, right = np.array([sym[k] for k in ks]), np.array([sym[nxt[k]] for k in ks])
        rank, merged = m.merges(left, right)
        drop = skipped(key, ks, left, right, rate)
        for k, a, b, r, x, d in zip(ks, left, right, rank, merged, drop, strict=True):
            if r != NEVER and not d:
                heapq.heappush(heap, (int(r), k, int(a), int(b), int(x)))

    offer(list(range(n - 1)))
    while heap:
        _, k, a, b, x = heapq.heappop(heap)
        if not alive[k] or sym[k] != a or nxt[k] >= n or sym[nxt[k]] != b:
            continue
        gone = nxt[k]
        sym[k], alive[gone], nxt[k] = x, False, nxt[gone]
        if nxt[k] < n:
            prev[nxt[k]] = k
        offer([prev[k], k])
    return [s for s, a in zip(sym, alive, strict=True) if a]


def _candidates(m: Model, sym, seg, keys, place, at, rate, met) -> tuple[np.ndarray, np.ndarray]:
    """Rank and result of merging the symbols at ``at`` with the next ones; ``met``
    collects the candidates."""
    last = at + 1 >= len(sym)
    after = np.where(last, at, at + 1)
    rank, merged = m.merges(sym[at], sym[after])
    rank[last | (seg[at] != seg[after])] = NEVER
    if rate > 0 or met is not None:
        ask = np.flatnonzero(rank != NEVER)
        k = at[ask]
        if met is not None:
            met.append((seg[k], place[k], sym[k], sym[k + 1]))
        if rate > 0:
            rank[ask[skipped(keys[seg[k]], place[k], sym[k], sym[k + 1], rate)]] = NEVER
    return rank, merged


def _advance(m: Model, sym: np.ndarray, seg: np.ndarray, keys: np.ndarray, rate: float, met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All segments together, one merge each a round. seg: segment of each symbol,
    ascending. Returns the final symbols and their segments."""
    seg = seg.astype(np.int32)
    place = (np.arange(len(sym)) - np.searchsorted(seg, seg)).astype(np.int32)
    done_sym, done_seg = [], []
    rank, merged = _candidates(m, sym, seg, keys, place, np.arange(len(sym)), rate, met)
    while len(sym):
        edge = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
        size = np.diff(np.append(edge, len(seg)))
        best = np.minimum.reduceat(rank, edge)
        busy = best != NEVER
        if not busy.all():
            live = np.repeat(busy, size)
            done_sym.append(sym[~live]), done_seg.append(seg[~live])
            sym, seg, place, rank, merged = (x[live] for x in (sym, seg, place, rank, merged))
            best, size = best[busy], size[busy]
            if not len(sym):
                break
        # the leftmost merge of best rank in each segment
        hit = np.flatnonzero(rank == np.repeat(best, size))
        pick = hit[np.append(True, seg[hit[1:]] != seg[hit[:-1]])]
        sym[pick] = merged[pick]
        live = np.ones(len(sym), dtype=bool)
        live[pick + 1] = False
        sym, seg, place, rank, merged = (x[live] for x in (sym, seg, place, rank, merged))
        now = pick - np.arange(len(pick))
        before = now[now > 0] - 1
        again = np.concatenate([now, before[seg[before] == seg[before + 1]]])
        rank[again], merged[again] = _candidates(m, sym, seg, keys, place, again, rate, met)
    sym, seg = np.concatenate(done_sym or [sym]), np.concatenate(done_seg or [seg])
    order = np.argsort(seg, kind="stable")
    return sym[order], seg[order]


def encode_block(m: Model, texts: list[str], keys: np.ndarray, seed: int, rate: float) -> list[np.ndarray]:
    """Ids of each text; ``keys`` (64-bit) tell the texts apart in the dropout."""
    points, lengths = [], []
    for t in texts:
        p = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
        lengths.append(len(p) + 1 if len(p) else 0)
        if len(p):
            points += [np.array([0x20], dtype=np.uint32), p]
    if not points:
        return [np.empty(0, dtype=np.int32) for _ in texts]
    points = np.concatenate(points)
    ends = np.cumsum(lengths)
    sym = m.char[points]
    sym[points == 0x20] = m.mark
    sym[points == ord(MARK)] = -1
    space, unknown = sym == m.mark, sym < 0
    head = np.zeros(len(sym), dtype=bool)
    head[(ends - lengths)[np.array(lengths) > 0]] = True
    head[1:] |= space[1:] & ~space[:-1] | unknown[1:] | unknown[:-1]
    start = np.flatnonzero(head)
    size = np.diff(np.append(start, len(sym)))
    doc = np.searchsorted(ends, start, "right")
    with np.errstate(over="ignore"):
        nth = (np.arange(len(start)) - np.searchsorted(doc, doc)).astype(np.uint64)
        own = _mixed(_mixed(keys[doc] + np.uint64(seed % 2**63)) + nth * _A)
        inside = (np.arange(len(sym)) - np.repeat(start, size)).astype(np.uint64)
        h = np.add.reduceat(_mixed((points.astype(np.uint64) + np.uint64(1)) * _A + (inside + np.uint64(1)) * _C), start)
        h = _mixed(h + size.astype(np.uint64) * _B)
    _, which, back = np.unique(h, return_index=True, return_inverse=True)
    long = size > LONG
    met: list | None = [] if rate > 0 else None
    part = [_encoded(m, sym, points, start[which], np.where(long[which], 0, size[which]), own[which], 0.0, met)]
    # segments with a skip, and long ones: an encoding of their own
    alone = np.flatnonzero(long | (_any_skip(met, len(which), back, own, rate) if rate > 0 else False))
    back[alone] = len(which) + np.arange(len(alone))
    part.append(_encoded(m, sym, points, start[alone], np.where(long[alone], 0, size[alone]), own[alone], rate))
    ids_at = np.flatnonzero(long[alone])
    heaps = [np.array(agenda(m, sym[start[k]:start[k] + size[k]].tolist(), own[k], rate), dtype=np.int32) for k in alone[ids_at]]
    part.append((np.concatenate(heaps or [np.empty(0, dtype=np.int32)]), np.repeat(ids_at, [len(x) for x in heaps])))
    out_sym = np.concatenate([x for x, _ in part])
    out_seg = np.concatenate([part[0][1], part[1][1] + len(which), part[2][1] + len(which)])
    if heaps:
        order = np.argsort(out_seg, kind="stable")
        out_sym, out_seg = out_sym[order], out_seg[order]
    count = np.bincount(out_seg, minlength=len(which) + len(alone))
    first = np.cumsum(count) - count
    each = count[back]
    ids = out_sym[np.repeat(first[back] - (np.cumsum(each) - each), each) + np.arange(each.sum())].astype(np.int32)
    per_doc = np.bincount(doc, weights=each, minlength=len(texts)).astype(np.int64)
    return np.split(ids, np.cumsum(per_doc)[:-1])


def _encoded(m: Model, sym, points, start, size, keys, rate: float, met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the segments at ``start`` and the segment of each id, ascending."""
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out_sym, out_seg = _advance(m, sym[at], np.repeat(np.arange(len(size)), size), keys, rate, met)
    odd = out_sym < 0
    if not odd.any():
        return out_sym, out_seg
    extra_sym, extra_seg = [], []
    for k in np.flatnonzero(odd):  # characters without a piece
        b = chr(points[start[out_seg[k]]]).encode()
        extra_sym.append(m.bytes[np.frombuffer(b, dtype=np.uint8)]), extra_seg.append(np.full(len(b), out_seg[k]))
    out_sym, out_seg = np.concatenate([out_sym[~odd], *extra_sym]), np.concatenate([out_seg[~odd], *extra_seg])
    order = np.argsort(out_seg, kind="stable")
    return out_sym[order], out_seg[order]


def _any_skip(met: list, n: int, which: np.ndarray, own: np.ndarray, rate: float) -> np.ndarray:
    """Is any merge met without dropout skipped for this occurrence? ``which``: the
    encoding, of ``n``, that each occurrence would share."""
    seg, place, left, right = (np.concatenate(x) for x in zip(*met, strict=True))
    order = np.argsort(seg, kind="stable")
    place, left, right = place[order], left[order], right[order]
    count = np.bincount(seg, minlength=n)
    first = np.cumsum(count) - count
    out = np.zeros(len(which), dtype=bool)
    for a in range(0, len(which), SHARE_ROWS):
        w = which[a:a + SHARE_ROWS]
        k = count[w]
        at = np.repeat(first[w] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        of = np.repeat(np.arange(len(w)), k)
        drop = skipped(own[a + of], place[at], left[at], right[at], rate)
        out[a + of[drop]] = True
    return out


def decode(m: Model, ids) -> str:
    return b"".join(map(m.text.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))[1:].decode()


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > BLOCK_CHARS:
            yield first, k
            first, size = k, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def _default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame, seed: int = SEED, rate: float = RATE, path: str | None = None, digest: bool = False) -> DataFrame:
    """doc_id, ids (array) — or, as ``digest``, n_ids, ids_crc32, decoded_sha256 and
    lossless, read back from the ids."""
    shipped(docs.sparkSession)
    path = path or _default_path()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            ids = batch.column("doc_id")
            for a, b in _blocks(texts):
                got = encode_block(m, texts[a:b], keys[a:b], seed, rate)
                if not digest:
                    yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array([x.tolist() for x in got], pa.list_(pa.int32()))], names=["doc_id", "ids"])
                    continue
                back = [decode(m, x) for x in got]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array([len(x) for x in got], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in got], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                    pa.array([t == s for t, s in zip(back, texts[a:b], strict=True)], pa.bool_())],
                    names=["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "lossless"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    d = d.withColumn("key", F.xxhash64("doc_id", F.length("text")))
    schema = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean" if digest else "doc_id long, ids array<int>"
    return d.mapInArrow(each, schema)


def op5_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir), digest=True)
