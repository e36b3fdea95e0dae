"""N-gram Jaccard join: a size-aware heavy-light join of word-shingle sets.

Two sets link when 100 * intersection >= 75 * union. The order of elements is
(frequent last, hash); linked sets then share an element among their first
``n - ceil(3n/4) + 1`` (the prefix), and, with one element more, at least two.

* Light sets (at most ``B`` elements) enumerate the 2-subsets of their longer prefix;
  light sets meet where they share a subset.
* Heavy sets scan the inverted lists of their prefix elements, which also hold the
  light sets large enough to link with a heavy one.
* ``B`` is where the counted cost is least: the subsets that all light sets of each
  size would enumerate against the list entries they would scan.

Frequent elements are those found often within some block of documents (in 1 /
``RARE`` of it) and at least ``FREQUENT`` times in such blocks, whatever the number of
documents, so that lists of rarer ones do not grow with the input; the list (at most ``MOST_FREQUENT`` hashes, the
most frequent) only sets the order, so no link depends on it.

Links, not all pairs: copies of one set are linked to its smallest id. In each list
every member is paired with two leaders, the smallest id and the smallest hash of an
id; pairs that share enough of their prefix are verified and components formed. In rounds
with other leaders, members of other components than the leader's follow, until a round
links few, so that large groups are one component before pairs are made. Then, exactly, every
pair in different components that can still link is verified: it shares an element among
the first ``n - needed + 1`` of both sets (``needed``: the overlap of two linked sets of
these sizes), can reach ``needed`` by the place of its last such element, and its parity
bitmaps (every element flips one bit) differ in no more bits than two linked sets may
have elements apart. The join of lists of ``BIG`` members tests the shortest form of the
bitmaps, so that near copies below the threshold give no rows; only one of the copies of a set has postings.

Defined cases: a null or empty text has an empty set, linked with nothing; one-shingle
sets link only when equal; a row with a null id keeps its set size and has a null
component; rows with equal ids are one document, linked by any of their texts; an
empty table gives no rows. Extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import documents, shipped, small_side, written
from .graph import components
from .shingles import shingle_sets

#: Largest size that can be light; sets up to it are kept whole for the cost counts.
MOST_LIGHT = 64
RARE = 4000
MOST_FREQUENT = 500_000
FREQUENT = 16
#: Elements counted together when frequent ones are looked for, and the least count.
COUNT_BLOCK, LOCAL_LEAST = 4_000_000, 2
#: Pairs of one leader that are verified together.
PAIRS_IN_CHUNK = 256
#: Least bits of a set's parity bitmap, which has a power of two and two for an element.
LEAST_BITS = 512
#: Numbers of 64 bits of the shortest form of the bitmaps.
FOLDS = 4
#: Rounds of leaders at most, and the share of the documents left that a round must link
#: for another one (1 / FEW); every pair that is left after them is verified in any case.
#: Lists of BIG members take part; a member of a shorter one gives fewer than BIG rows.
ROUNDS, LEADERS, FEW, BIG = 8, 6, 500, 32
#: Set uses that may be broadcast.
BROADCAST_USES = 250_000
FLUSH_BYTES = 4 << 20


def prefix_length(n: int, more: int = 0) -> int:
    return min(n, n - -(-3 * n // 4) + 1 + more)


# -- sets ------------------------------------------------------------------------

def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: size, digest of the set, its parity bitmap, the set itself if small.
    Extra rows (doc null, key null): hashes frequent within a block of documents."""
    held, size = [], 0

    def frequent() -> pa.RecordBatch | None:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= max(LOCAL_LEAST, len(held) // RARE)
        values, counts = values[often].view(np.int64), counts[often].astype(np.int64)
        none = [None] * len(values)
        return _rows(none, counts, none, none, none, none, values)

    for batch in batches:
        n, keys, bits, folds, small = [], [], [], [], []
        for s in shingle_sets(batch.column("text")):
            raw = s.tobytes()
            n.append(len(s))
            keys.append(xxhash.xxh3_128_digest(raw))
            bits.append(parity_bitmap(s))
            folds.append(folded(bits[-1]))
            small.append(raw if len(s) <= MOST_LIGHT else None)
            held.append(s)
            size += len(s)
            if size > COUNT_BLOCK:
                yield frequent()
                held, size = [], 0
        yield _rows(batch.column("doc_id"), n, keys, bits, folds, small, [None] * len(n))
    if held:
        yield frequent()


def parity_bitmap(s: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of the set's hashes end in i. Two bitmaps of one
    length differ in at most as many bits as the sets have elements apart; the halves of
    a bitmap give the next shorter one by exclusive or."""
    bits = max(LEAST_BITS, 1 << (2 * len(s) - 1).bit_length()) if len(s) else LEAST_BITS
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: bytes) -> np.ndarray:
    """A bitmap's shortest form, as FOLDS numbers."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, dtype=np.int64).reshape(-1, FOLDS), axis=0)


def bits_apart(x: bytes, y: bytes) -> int:
    x, y = (np.frombuffer(z, dtype=np.uint64) for z in sorted((x, y), key=len))
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _near_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose bitmaps differ in at most ``apart`` bits."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("bits_a", "bits_b", "apart")), strict=True)
        keep = pa.array([bits_apart(x, y) <= apart for x, y, apart in rows], pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


def _rows(doc, n, key, bits, folds, small, often) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        doc if isinstance(doc, pa.Array) else pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
        pa.array(bits, pa.binary()), pa.array(folds, pa.list_(pa.int64())), pa.array(small, pa.binary()), pa.array(often, pa.int64())],
        names=["doc_id", "n", "key", "bits", "folds", "small", "often"])


def described(docs: DataFrame) -> DataFrame:
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return written(d.mapInArrow(_describe, "doc_id long, n long, key binary, bits binary, folds array<long>, small binary, often long"), "shingle-sets")


def frequent_hashes(sets: DataFrame) -> np.ndarray:
    """A sorted list of at most MOST_FREQUENT hashes."""
    f = sets.filter(F.col("key").isNull()).groupBy("often").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= FREQUENT)
    top = f.orderBy(F.desc("n"), "often").limit(MOST_FREQUENT).select("often").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


# -- boundary --------------------------------------------------------------------

def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        e, n = [], []
        for raw in batch.column("small").to_pylist():
            s = np.frombuffer(raw, dtype=np.int64)
            p = prefix_length(len(s))
            e.append(s[:p])
            n.append(np.full(p, len(s)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(e) if e else [], pa.int64()),
                                          pa.array(np.concatenate(n) if n else [], pa.int64())], names=["e", "n"])


def boundary(sets: DataFrame) -> int:
    """The light size of least cost, from counts over all distinct sets of up to
    MOST_LIGHT elements (one row per size comes to the driver)."""
    light = sets.filter(F.col("key").isNotNull() & F.col("n").between(2, MOST_LIGHT)).groupBy("key") \
        .agg(F.first("small").alias("small")).select("small").mapInArrow(_scanned, "e long, n long")
    lists = written(light.groupBy("e", "n").agg(F.count(F.lit(1)).alias("sets")), "light-lists")
    length = lists.groupBy("e").agg(F.sum("sets").alias("length"))
    got = lists.join(length, "e").groupBy("n").agg(F.sum(F.col("sets") * F.col("length")).alias("scan"), F.sum("sets").alias("entries")).collect()
    scan, subsets = np.zeros(MOST_LIGHT + 1), np.zeros(MOST_LIGHT + 1)
    for r in got:
        p = prefix_length(r["n"], 1)
        scan[r["n"]] = r["scan"]
        subsets[r["n"]] = r["entries"] / prefix_length(r["n"]) * p * (p - 1) / 2
    cost = np.cumsum(subsets) + scan.sum() - np.cumsum(scan)
    return int(np.argmin(cost[1:])) + 1


# -- lists -----------------------------------------------------------------------

def _postings(light: int, frequent: bytes):
    """Rows (sig, doc_id, meta): meta packs the set size, the place of the element in
    the order (of 2-subsets: 0), and whether sig is a 2-subset's."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(frequent, dtype=np.uint64)
        seen: set[bytes] = set()  # sets of this task: copies give the same rows
        sig, meta, doc, held = [], [], [], 0

        def rows() -> pa.RecordBatch:
            count = [len(x) for x in sig]
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.repeat(np.array(doc, dtype=np.int64), count)),
                pa.array(np.concatenate(meta))], names=["sig", "doc_id", "meta"])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for d, s in zip(ids, shingle_sets(batch.column("text")), strict=True):
                n = len(s)
                if d is None or n < 2:
                    continue
                key = xxhash.xxh3_128_digest(s.tobytes())
                if key in seen:
                    continue
                seen.add(key)
                p = prefix_length(n, 1)
                if len(often):
                    hit = np.searchsorted(often, s)
                    hot = often[np.minimum(hit, len(often) - 1)] == s
                    s = np.concatenate([s[~hot], s[hot]]) if hot[:p].any() else s
                if n <= light:
                    a, b = np.triu_indices(p, 1)
                    low, high = np.minimum(s[a], s[b]), np.maximum(s[a], s[b])
                    sig.append(low * np.uint64(0x9E3779B97F4A7C15) + (high ^ (high >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
                    meta.append(np.full(len(a), (n << 32) + 1, dtype=np.int64)), doc.append(d)
                    held += len(a)
                if n > light or 4 * n >= 3 * (light + 1):
                    p = prefix_length(n)
                    sig.append(s[:p])
                    meta.append((n << 32) + 2 * np.arange(p, dtype=np.int64)), doc.append(d)
                    held += p
                if held > FLUSH_BYTES // 8:
                    yield rows()
                    sig, meta, doc, held = [], [], [], 0
        if sig:
            yield rows()
    return emit


def shared_lists(docs: DataFrame, light: int, frequent: np.ndarray) -> DataFrame:
    """Postings of every signature that more than one document has, each with the
    list's two leaders and their sizes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")) \
        .mapInArrow(_postings(light, frequent.tobytes()), "sig long, doc_id long, meta long")
    w = Window.partitionBy("sig")
    size = lambda c: F.shiftright(c, 32).cast("int")
    rows = rows.withColumn("first", F.min(F.struct("doc_id", "meta")).over(w)).withColumn("last", F.max("doc_id").over(w)) \
        .withColumn("other", F.min(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id", "meta")).over(w))
    return written(rows.filter(F.col("last") > F.col("first")["doc_id"]).select(
        "sig", "doc_id", size("meta").alias("n"), F.shiftright(F.col("meta").bitwiseAND(F.lit(2**32 - 1)), 1).cast("int").alias("at"),
        (F.col("meta").bitwiseAND(F.lit(1)) == 1).alias("pairs"), F.col("first")["doc_id"].alias("lead_0"), size(F.col("first")["meta"]).alias("n_0"),
        F.col("other")["doc_id"].alias("lead_1"), size(F.col("other")["meta"]).alias("n_1")),
        "shared-lists")


def _sizes_fit(a: Column, b: Column) -> Column:
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def _needed(a: Column, b: Column) -> Column:
    return F.ceil(3 * (a + b) / 7)


def _behind(n: Column) -> Column:
    """Elements behind the prefix."""
    return F.ceil(3 * n / 4) - 1


# -- verification ----------------------------------------------------------------

def _used_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's set once for every use it has."""
    names = ["a", "chunk", "member", "id", "set"]
    out, held = [[] for _ in names], 0
    for batch in batches:
        uses, ids = batch.column("uses"), batch.column("doc_id").to_pylist()
        for k, s in enumerate(shingle_sets(batch.column("text"))):
            raw = s.tobytes()
            for use in uses[k].as_py():
                for col, v in zip(out, (use["a"], use["chunk"], use["member"], ids[k], raw), strict=True):
                    col.append(v)
                held += len(raw) + 32
                if held > FLUSH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _USED, strict=True)], names=names)
                    out, held = [[] for _ in names], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _USED, strict=True)], names=names)


_USED = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, chunk, member): the leader's sets, then its members'."""
    now, lead = None, []
    for batch in batches:
        a, b = [], []
        cols = [batch.column(c) for c in ("a", "chunk", "member", "id", "set")]
        heads = list(zip(*(c.to_pylist() for c in cols[:4]), strict=True))
        for k, (leader, chunk, member, doc) in enumerate(heads):
            if (leader, chunk) != now:
                now, lead = (leader, chunk), []
            s = np.frombuffer(cols[4][k].as_buffer(), dtype=np.uint64)
            if not member:
                lead.append(s.copy())
                continue
            for x in lead:
                common = len(x) + len(s) - len(np.union1d(x, s))
                if 100 * common >= 75 * (len(x) + len(s) - common):
                    a.append(leader), b.append(doc)
                    break
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link. A leader with many pairs is dealt out in
    chunks, each with its own copy of the leader's set."""
    pairs = written(pairs.select("a", "b"), "pairs")
    chunks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_IN_CHUNK).alias("chunks"))
    dealt = pairs.join(chunks, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")))
    members = dealt.select(F.col("b").alias("id"), F.struct("a", "chunk", F.lit(True).alias("member")).alias("use"))
    leaders = chunks.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")) \
        .select(F.col("a").alias("id"), F.struct("a", "chunk", F.lit(False).alias("member")).alias("use"))
    uses = written(members.union(leaders).groupBy("id").agg(F.collect_list("use").alias("uses")), "uses")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    total = uses.agg(F.sum(F.size("uses"))).first()[0] or 0
    sets = d.join(small_side(uses, total, BROADCAST_USES), F.col("doc_id") == F.col("id")).select("doc_id", "text", "uses") \
        .mapInArrow(_used_sets, "a long, chunk long, member boolean, id long, set binary")
    return sets.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "member") \
        .mapInArrow(_linked, "a long, b long")


# -- join ------------------------------------------------------------------------

def _star_pairs(members: DataFrame, light: int) -> DataFrame:
    """Pairs (a: leader, b: member) likely to link, from rows of lists with their
    leader (``lead``, ``lead_n``)."""
    both_light = (F.col("n") <= light) & (F.col("lead_n") <= light)
    star = members.filter((F.col("doc_id") != F.col("lead")) & _sizes_fit(F.col("n"), F.col("lead_n")) & (F.col("pairs") == both_light)) \
        .groupBy(F.col("lead").alias("a"), F.col("doc_id").alias("b")).agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n"), F.max("pairs").alias("light"))
    return star.filter(F.col("light") | (4 * F.col("m") >= F.col("n") - _behind(F.col("n"))))


def _mixed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The lists whose members are in different components, with their numbers of members."""
    placed = _placed(lists, found)
    mixed = placed.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members")).filter("lo <> hi").select("sig", "members")
    return written(placed.join(mixed, "sig"), "mixed-lists")


def _placed(lists: DataFrame, found: DataFrame) -> DataFrame:
    return lists.join(small_side(found, found.count()), F.col("doc_id") == F.col("id"), "left") \
        .drop("id").withColumn("component", F.coalesce("component", "doc_id"))


def _may_link(x, y, light: int) -> Column:
    """Whether rows x and y of one list can link by their sizes and the places of their
    shared element."""
    xn, yn = x("n"), y("n")
    return _sizes_fit(xn, yn) & (x("pairs") == ((xn <= light) & (yn <= light))) \
        & (x("pairs") | ((x("at") <= xn - _needed(xn, yn)) & (y("at") <= yn - _needed(xn, yn))))


def _folds_fit(x, y) -> Column:
    """Whether two sets' shortest bitmaps differ in few enough bits."""
    xn, yn = x("n"), y("n")
    return sum(F.bit_count(x("folds")[k].bitwiseXOR(y("folds")[k])) for k in range(FOLDS)) <= xn + yn - 2 * _needed(xn, yn)


def _leader_pairs(big: DataFrame, folds: DataFrame, light: int, turn: int) -> DataFrame:
    """Each list's LEADERS members of least seeded hashes with the members of other components."""
    least = lambda seed: F.min(F.struct(F.xxhash64("doc_id", F.lit(seed)).alias("h"), "doc_id", "n", "pairs", "at", "component"))
    lead = big.groupBy("sig").agg(*[least(turn * LEADERS + k).alias(f"lead_{k}") for k in range(LEADERS)]) \
        .select("sig", F.explode(F.array(*[f"lead_{k}" for k in range(LEADERS)])).alias("lead"))
    met = big.join(lead, "sig").filter((F.col("component") != F.col("lead")["component"]) & _may_link(lambda c: F.col("lead")[c], F.col, light))
    pairs = met.select(F.col("lead")["doc_id"].alias("a"), F.col("lead")["n"].alias("n_a"), F.col("doc_id").alias("b"), F.col("n").alias("n_b")).distinct()
    of = lambda c: folds.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("folds").alias(f"folds_{c}"))
    pairs = pairs.join(of("a"), ["a", "n_a"]).join(of("b"), ["b", "n_b"])
    return pairs.filter(_folds_fit(lambda c: F.col(f"{c}_a"), lambda c: F.col(f"{c}_b"))).select("a", "b").distinct()


def _meetings(lists: DataFrame, light: int, bitmaps: bool = False) -> DataFrame:
    """Rows of one list and different components that may link; ``bitmaps``: by their
    shortest bitmaps too."""
    x, y = lists.alias("x"), lists.alias("y")
    left, right = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    xn, yn = F.col("x.n"), F.col("y.n")
    behind_too = F.least("x.nth", "y.nth") + 1 + F.least(xn - 1 - F.col("x.at"), yn - 1 - F.col("y.at")) >= _needed(xn, yn)
    on = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.component") < F.col("y.component")) & _may_link(left, right, light) & (F.col("x.pairs") | behind_too)
    return x.join(y, on & _folds_fit(left, right) if bitmaps else on) \
        .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), xn.alias("n_a"), yn.alias("n_b"),
                F.col("x.pairs").alias("light"), F.col("x.at").alias("at_a"), F.col("y.at").alias("at_b"))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components (id, component) after more links between documents."""
    at = lambda c: found.select(F.col("id").alias(c), F.col("component").alias(f"at_{c}"))
    moved = components(links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("at_a", "a").alias("a"), F.coalesce("at_b", "b").alias("b")))
    to = moved.select(F.col("id").alias("component"), F.col("component").alias("to"))
    return written(found.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component")).union(moved), "components")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    shipped(docs.sparkSession)
    sets = described(docs)
    own = sets.filter(F.col("key").isNotNull())
    keyed = own.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).select("doc_id", "key")
    copies = keyed.join(keyed.groupBy("key").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("k")).filter("k > 1"), "key") \
        .select("a", F.col("doc_id").alias("b")).filter("a <> b")
    light = boundary(sets)
    # copies, linked above, need no postings; an id with several sets keeps them all
    several = keyed.groupBy("doc_id").agg(F.count_distinct("key").alias("k")).filter("k > 1").select(F.col("doc_id").alias("b"))
    gone = written(copies.select("b").distinct().join(several, "b", "left_anti"), "copies")
    first = docs.join(small_side(gone, gone.count()), F.col("doc_id").cast("long") == F.col("b"), "left_anti")
    lists = shared_lists(first, light, frequent_hashes(sets))

    leads = [lists.select("doc_id", "n", "pairs", F.col(f"lead_{k}").alias("lead"), F.col(f"n_{k}").alias("lead_n")) for k in (0, 1)]
    star = _star_pairs(leads[0], light).union(_star_pairs(leads[1], light)).select("a", "b").distinct()
    key_of = lambda c: keyed.select(F.col("doc_id").alias(c), F.col("key").alias(f"key_{c}"))
    star = star.join(key_of("a"), "a").join(key_of("b"), "b").filter("key_a <> key_b").select("a", "b")
    links = written(copies.union(verified(docs, star)), "star-links")
    found = components(links)
    rest = _mixed(lists, found)
    big = rest.filter(F.col("members") >= BIG).drop("component")
    ids = written(big.select(F.col("doc_id").alias("b")).distinct(), "big-ids")
    size = ids.count()
    folds = written(own.join(small_side(ids, size), F.col("doc_id") == F.col("b"), "left_semi").select("doc_id", F.col("n").cast("int").alias("n"), "folds"), "big-folds")
    if size:
        texts = written(docs.select("doc_id", "text").join(small_side(ids, size), F.col("doc_id").cast("long") == F.col("b"), "left_semi"), "big-texts")
        before = found
        for turn in range(ROUNDS):
            more = written(verified(texts, _leader_pairs(_placed(big, found), folds, light, turn)), "leader-links")
            n_more = more.count()
            found = _merged(found, more) if n_more else found
            if n_more <= size // FEW:
                break
        if found is not before:
            rest = _mixed(rest.drop("component", "members"), found)

    # nth: elements of the document in these lists before this one; two documents in
    # different components share no others
    rest = rest.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "pairs").orderBy("at", "sig")) - 1)
    small_lists = rest.filter(F.col("members") < BIG)
    large_lists = rest.filter(F.col("members") >= BIG).join(folds, ["doc_id", "n"])
    met = _meetings(small_lists, light).union(_meetings(large_lists, light, bitmaps=True))
    pairs = met.groupBy("a", "b", "n_a", "n_b").agg(F.max("light").alias("light"), F.count(F.lit(1)).alias("shared"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b"))
    # overlap: the shared elements found, and at most what stands behind the last one
    needed = _needed(F.col("n_a"), F.col("n_b"))
    pairs = pairs.filter(F.col("light") | (F.col("shared") + F.least(F.col("n_a") - 1 - F.col("at_a"), F.col("n_b") - 1 - F.col("at_b")) >= needed))
    bits_of = lambda c: own.select(F.col("doc_id").alias(c), F.col("n").cast("int").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    pairs = pairs.select("a", "n_a", "b", "n_b", (F.col("n_a") + F.col("n_b") - 2 * needed).alias("apart")) \
        .join(bits_of("a"), ["a", "n_a"]).join(bits_of("b"), ["b", "n_b"]) \
        .select("a", "b", "bits_a", "bits_b", "apart").mapInArrow(_near_enough, "a long, b long").distinct()
    more = written(verified(docs, pairs), "rest-links")
    if not more.isEmpty():
        found = _merged(found, more)
    return own.select("doc_id", F.col("n").alias("n_shingles")).join(found, F.col("doc_id") == F.col("id"), "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


SQL = """
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as id, doc_id as c from w union select e.b, r.c from r join e on e.a = r.id where r.c < e.b)
select w.doc_id, coalesce(n.n, 0) as n_shingles, k.c as component_id
from w left join n using (doc_id) join (select id, min(c) as c from r group by id) k on k.id = w.doc_id"""
