"""The packing plan: through linear grouping, near the bound, exact on small cases."""
import random
from collections import Counter
from itertools import combinations_with_replacement

import pytest
from pyspark.sql import functions as F

from sluice.llm import packing


def _bins(plan):
    """Every piece placed once; lengths of each sequence, without gaps."""
    out, ranks = {}, {}
    for length, rank, count, first, offset in plan.slots:
        for k in range(count):
            out.setdefault(first + k, []).append((offset, length))
            ranks.setdefault(length, []).append(rank + k)
    assert sorted(out) == list(range(plan.bins))
    for slots in out.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= plan.capacity
    return out, {n: sorted(r) for n, r in ranks.items()}


def _optimum(items, capacity):
    """Fewest bins by branch and bound."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for room in sorted(set(bins)):
            if room >= items[k]:
                rest = list(bins)
                rest.remove(room)
                place(k + 1, [*rest, room - items[k]])
        place(k + 1, [*bins, capacity - items[k]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(6))
def test_every_group_count_places_every_piece(seed):
    r = random.Random(seed)
    counts = Counter(min(1024, 1 + int(r.expovariate(1 / 300))) for _ in range(5000))
    bound = -(-sum(n * k for n, k in counts.items()) // 1024)
    for groups in packing.GROUPS:
        _, ranks = _bins(packing.plan_packing(dict(counts), groups))
        assert ranks == {n: list(range(k)) for n, k in counts.items()}
    assert packing.best_plan(dict(counts)).bins <= 1.005 * bound + 1


def test_lengths_are_rounded_in_groups_of_equal_size():
    counts = {n: 7 for n in range(129, 1025)}
    for groups in packing.GROUPS:
        queues = packing._grouped(counts, sorted(counts, reverse=True), groups)
        each = -(-7 * len(counts) // groups)
        sizes = [sum(q[2] for q in queue) for queue in queues.values()]
        assert len(queues) <= groups < len(counts) and max(sizes) <= 2 * each
        assert all(q[0] <= size for size, queue in queues.items() for q in queue)


def test_small_cases_against_the_optimum():
    worse = total = 0
    for items in list(combinations_with_replacement((3, 4, 5, 6, 7), 6))[::5]:
        plan = packing.best_plan(dict(Counter(items)), capacity=10)
        _bins(plan)
        best = _optimum(items, 10)
        assert best <= plan.bins <= best + 1
        worse, total = worse + (plan.bins > best), total + 1
    assert worse <= 0.1 * total


def test_repeated_and_null_ids_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BLOCK", 50)
    d = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same words").alias("text")).repartition(2)
    rows = packing.packed(d).collect()
    assert len(rows) == 1000 and len({(r.sequence_id, r.offset) for r in rows}) == 1000
    cut = spark.createDataFrame([(None, 0, 0, 3, 7, k) for k in range(1000)],
                                "doc_id long, piece int, start long, length long, ids_crc32 long, seen long")
    assert sorted(r["rank"] for r in packing._ranked(cut, 1000).collect()) == list(range(1000))
    blocks = cut.select(F.pmod(F.xxhash64("doc_id", "piece", "seen"), F.lit(20)).alias("b")).distinct().count()
    assert blocks > 10
