"""Word-shingle sets as sorted 64-bit hashes, computed a block of bytes at a time.

Words are the stretches without ASCII white space, A-Z lower-cased; a shingle is five
consecutive words, and a text with fewer words is one shingle. Two different shingles
get the same hash with a probability of about 2**-60.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
#: Bytes of text that are hashed together; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_RANDOM = np.random.Generator(np.random.PCG64(20240201))
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_MULTIPLY = _RANDOM.integers(0, 2**63, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = 0x9E3779B97F4A7C17  # odd, 3 mod 4
_INVERSE = pow(_POWER, -1, 2**64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_POWER, _INVERSE):
        p = np.full(n + 1, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _block(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document of one block."""
    docs, size = len(offsets) - 1, len(data)
    data = _LOWER[data]
    word = _WORD[data]
    edge = np.zeros(size + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(size, dtype=bool)
    before[:1], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(size, dtype=bool)
    after[-1:], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    up, down = _powers(max(BLOCK_BYTES, 1 << size.bit_length()))
    total = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:size], out=total[1:])
    h = _mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _MULTIPLY[SHINGLE])
    at = np.searchsorted(starts, offsets)
    if len(h) >= SHINGLE:
        s = sum(h[k:len(h) - SHINGLE + 1 + k] * _MULTIPLY[k] for k in range(SHINGLE))
        s = _mixed(s)
    for d in range(docs):
        a, b = at[d], at[d + 1]
        if b - a >= SHINGLE:
            yield np.unique(s[a:b - SHINGLE + 1])
        elif b > a:
            yield _mixed(np.array([np.sum(h[a:b] * _MULTIPLY[:b - a]) + np.uint64(b - a)], dtype=np.uint64))
        else:
            yield np.empty(0, dtype=np.uint64)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """One sorted array of distinct hashes per text (null: empty)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1)
        last = min(last, len(texts))
        yield from _block(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last
