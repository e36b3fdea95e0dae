"""Best-fit packing of token sequences by the linear grouping scheme.

Spark tokenises the documents and cuts them into pieces of at most ``CAPACITY``
tokens. Only the count of pieces by length (at most CAPACITY numbers) comes to the
driver, whatever the corpus. There
  1. lengths over ``CAPACITY // SMALL`` are sorted and dealt into groups of equal
     cardinality, each rounded up to its largest length;
  2. configurations of the few rounded sizes are chosen, each the fullest that holds
     the largest size left, and used as often as the counts allow;
  3. each group's actual lengths take the places of the rounded ones;
  4. small lengths go, largest first, to the sequence with the least room that fits.
The plan is a list of slots: so many pieces of one length, from a rank on, go to
consecutive sequences at one offset. Several group counts are tried on the counts and
the plan with the fewest sequences is kept; every plan goes through the grouping. Spark then ranks the pieces of each length
(in blocks, so that no length is ranked by one task) and joins them with the slots.

Token ids: those of ``tokenizers`` with ``byte_bpe_50k.json`` and its default settings,
so ``<|endoftext|>`` in a text is the file's added token (``special=False``: ordinary
text); id 2 ends each document. The ids come from the vocabulary's rank file, which
gives the same ids several times faster; texts with an added token, or with a long run
of white space, on which the rank file's reader fails, are read with ``tokenizers``.

Defined cases: a null or empty text is the single token 2; repeated rows and null ids
are packed like other documents; an empty table gives no rows. Extra columns are
ignored.
"""
from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, shipped, text_or_empty, written

CAPACITY = 1024
END = 2
#: Lengths up to CAPACITY // SMALL are small.
SMALL = 8
#: Numbers of groups that are tried.
GROUPS = (64, 128, 256, 512)
#: Pieces ranked together.
RANK_BLOCK = 50_000
#: White space in a row from which tokenizers reads the text (tiktoken fails near 1,000,000).
LONG_SPACE = 100_000


# -- tokens ----------------------------------------------------------------------

@lru_cache(maxsize=2)
def _encoder(ranks_path: str):
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _tokenizer(special: bool):
    """The tokenizer, and the strings of its added tokens if they are read as such."""
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = not special
    return t, [a.content for a in t.get_added_tokens_decoder().values()] if special else []


def _long_space(text: str) -> bool:
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in re.finditer(r"\s+", text))


def token_ids(ranks_path: str, text: str, special: bool = False) -> np.ndarray:
    """Ids of one document, with the ending id."""
    tokenizer, added = _tokenizer(special)
    if any(a in text for a in added) or _long_space(text):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
    else:
        ids = _encoder(ranks_path).encode_ordinary(text)
    return np.array([*ids, END], dtype="<u4")


def _cut(ranks_path: str, capacity: int, special: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = token_ids(ranks_path, text.as_py(), special)
                first = len(ids) - capacity * (-(-len(ids) // capacity) - 1)
                start, end, piece = 0, first, 0
                while start < len(ids):
                    rows.append((doc, piece, start, end - start, zlib.crc32(ids[start:end].tobytes()), seen))
                    seen += 1
                    start, end, piece = end, end + capacity, piece + 1
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PIECE, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "seen"])
    return cut


_PIECE = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def pieces(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, special: bool = False) -> DataFrame:
    """The pieces of all documents. ``seen`` counts within a task: it is written with the
    piece and deals repeated and null ids over the blocks of ranks."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return d.mapInArrow(_cut(ranks_path, capacity, special), "doc_id long, piece int, start long, length long, ids_crc32 long, seen long")


# -- plan, from counts by length ---------------------------------------------------

class _Plan:
    """Slots and the sequences that still have room, as runs of equal sequences."""

    def __init__(self, capacity: int):
        self.capacity, self.bins = capacity, 0
        self.slots: list[tuple[int, int, int, int, int]] = []  # length, rank, count, bin, offset
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: (bin, count)
        self.rooms: list[int] = []

    def leave(self, room: int, first: int, count: int) -> None:
        if room > 0 and count > 0:
            if not self.room[room]:
                bisect.insort(self.rooms, room)
            self.room[room].append((first, count))

    def put(self, length: int, rank: int, count: int, first: int, used: int) -> None:
        self.slots.append((length, rank, count, first, used))

    def best_fit(self, length: int, rank: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                per = self.capacity // length
                n, fill = (count // per, per) if count >= per else (1, count)
                for k in range(fill):
                    self.put(length, rank + k * n, n, self.bins, k * length)
                self.leave(self.capacity - fill * length, self.bins, n)
                self.bins, rank, count = self.bins + n, rank + n * fill, count - n * fill
                continue
            room = self.rooms[at]
            first, n = self.room[room].pop()
            if not self.room[room]:
                self.rooms.pop(at)
            take = min(n, count)
            self.put(length, rank, take, first, self.capacity - room)
            self.leave(room - length, first, take)
            self.leave(room, first + take, n - take)
            rank, count = rank + take, count - take


def _fullest(sizes: list[int], left: dict[int, int], first: int, capacity: int) -> dict[int, int]:
    """The fullest configuration that holds ``first``: reachable fills as bits."""
    room = capacity - first
    stages, fills, mask = [], 1, (1 << (room + 1)) - 1
    for s in sizes:
        for _ in range(min(left[s] - (s == first), room // s)):
            more = fills | (fills << s) & mask
            if more == fills:
                break
            stages.append((s, fills))
            fills = more
    fill, config = fills.bit_length() - 1, defaultdict(int, {first: 1})
    for s, before in reversed(stages):
        if not before >> fill & 1:
            config[s] += 1
            fill -= s
    return config


def _grouped(counts: dict[int, int], large: list[int], groups: int) -> dict[int, list[list[int]]]:
    """Linear grouping: rounded size -> actual [length, rank, count], largest first."""
    each = -(-sum(counts[n] for n in large) // groups)
    queues: dict[int, list[list[int]]] = {}
    size = room = 0
    for n in large:
        rank, left = 0, counts[n]
        while left:
            if not room:
                size, room = n, each
            take = min(left, room)
            queues.setdefault(size, []).append([n, rank, take])
            rank, left, room = rank + take, left - take, room - take
    return queues


def _pulled(queue: list[list[int]], count: int) -> list[list[int]]:
    """The next ``count`` items of a group as stretches [length, rank, count]."""
    out = []
    while count:
        n, rank, have = queue[0]
        take = min(count, have)
        out.append([n, rank, take])
        queue[0] = [n, rank + take, have - take]
        if take == have:
            queue.pop(0)
        count -= take
    return out


def plan_packing(counts: dict[int, int], groups: int, capacity: int = CAPACITY, small: int = SMALL) -> _Plan:
    plan = _Plan(capacity)
    queues = _grouped(counts, sorted((n for n in counts if n > capacity // small), reverse=True), groups)
    left = {s: sum(q[2] for q in queues[s]) for s in queues}
    sizes = sorted(left, reverse=True)
    while sizes:
        config = _fullest(sizes, left, sizes[0], capacity)
        times = min(left[s] // k for s, k in config.items())
        places = [_pulled(queues[s], times) for s, k in config.items() for _ in range(k)]
        while places[0]:  # runs of sequences with equal actual lengths
            run, used = min(p[0][2] for p in places), 0
            for p in places:
                n, rank, have = p[0]
                plan.put(n, rank, run, plan.bins, used)
                used += n
                p[0] = [n, rank + run, have - run]
                if have == run:
                    p.pop(0)
            plan.leave(capacity - used, plan.bins, run)
            plan.bins += run
        for s, k in config.items():
            left[s] -= k * times
        sizes = [s for s in sizes if left[s]]
    for n in sorted((n for n in counts if n <= capacity // small), reverse=True):
        plan.best_fit(n, 0, counts[n])
    return plan


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> _Plan:
    return min((plan_packing(counts, g, capacity) for g in GROUPS), key=lambda p: p.bins)


# -- packing -----------------------------------------------------------------------

def _ranked(cut: DataFrame, n: int) -> DataFrame:
    """Rank of each piece within its length: within blocks, then over the blocks."""
    blocks = max(1, n // RANK_BLOCK)
    b = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "seen"), F.lit(blocks)))
    of = b.groupBy("length", "block").agg(F.count(F.lit(1)).alias("k"))
    over = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    of = of.select("length", "block", F.coalesce(F.sum("k").over(over), F.lit(0)).alias("before"))
    inner = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32", "seen")
    return b.withColumn("inner", F.row_number().over(inner) - 1).join(of, ["length", "block"]) \
        .withColumn("rank", F.col("before") + F.col("inner")).drop("block", "inner", "before")


def packed(docs: DataFrame, ranks_path: str | None = None, capacity: int = CAPACITY, special: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    shipped(docs.sparkSession)
    if ranks_path is None:
        import public_tokenizers
        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    cut = written(pieces(docs, ranks_path, capacity, special), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most CAPACITY numbers
    if not counts:
        none = F.lit(None).cast("long")
        return cut.drop("seen").withColumns({"sequence_id": none, "offset": none})
    plan = best_plan(counts, capacity)
    slots = literal_table(cut.sparkSession, plan.slots)
    joined = _ranked(cut, sum(counts.values())).join(
        F.broadcast(slots), (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("s_rank")) & (F.col("rank") < F.col("s_rank") + F.col("s_count")))
    return joined.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("s_bin") + F.col("rank") - F.col("s_rank")).alias("sequence_id"), F.col("s_offset").alias("offset"))


def literal_table(spark: SparkSession, slots: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The plan's slots: their number depends on CAPACITY and GROUPS, not on the corpus."""
    names = ["s_length", "s_rank", "s_count", "s_bin", "s_offset"]
    table = pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*slots, strict=True)], names=names)
    return spark.createDataFrame(table)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir).select("doc_id", "text"), special=True)
