"""Balanced label propagation: the law, the slots, the groups; and exact ranks."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillwright.llm import sharding
from tillwright.llm.common import ranked


def placed(spark, rows, n_shards=24, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"shard": F.lit("clash"), "v": F.lit(1)}).repartition(4)
    out = sharding.balanced_shards(df, n_shards, **more).collect()
    assert len(out) == len(rows)
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[t]) for t in range(n_shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows) and set(slots) <= set(range(n_shards))
    return out


def cuts(out):
    """Shards beyond the first that each text lies in."""
    where = defaultdict(set)
    for r in out:
        where[r["link"]].add(r["shard"])
    return {k: len(v) - 1 for k, v in where.items()}


def test_groups_stay_together(spark):
    rng = random.Random(1)
    rows = [(i, f"text {i % 40}" if i < 120 else f"alone {i}") for i in range(400)]
    rng.shuffle(rows)
    assert sum(cuts(placed(spark, rows, 8)).values()) == 0


def test_a_group_larger_than_a_shard_fills_whole_shards(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i // 2}") for i in range(300)]
    out = placed(spark, rows, 10)
    hot = [r["shard"] for r in out if r["link"] == next(x["link"] for x in out if x["doc_id"] == 0)]
    assert len(set(hot)) <= 5  # 100 rows, 30 a shard
    assert sum(cuts(out).values()) <= 12


def test_all_rows_equal(spark):
    placed(spark, [(i, "same") for i in range(50)], 7)


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(1, None), (None, None), (1, ""), (2, "é" * 50_000), (2, "é" * 50_000)]])
def test_edges(spark, rows):
    placed(spark, rows)


def test_quotas_swap_and_fill_room():
    granted = sharding._quotas({(0, 1): 5, (1, 0): 3, (2, 1): 4}, [0, 3, 0])
    assert sorted(granted) == [(0, 1, 5), (1, 0, 3), (2, 1, 1)]


def test_ranks_are_gapless_in_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice("aab"), rng.randint(0, 20), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(7)
    for group in ([], ["g"]):
        by = defaultdict(list)
        for r in ranked(df, ["x", "i"], group).collect():
            by[r["g"] if group else 0].append((r["rank"], r["x"], r["i"]))
        for got in by.values():
            got.sort()
            assert [r[0] for r in got] == list(range(len(got))) and [r[1:] for r in got] == sorted(r[1:] for r in got)


def least_cut(sizes, capacity):
    """The lowest cut of groups of these sizes over shards of this capacity, by trying all ways to lay them out."""
    best = [sum(sizes)]

    def lay(k, room, cut):
        if cut >= best[0]:
            return
        if k == len(sizes):
            best[0] = cut
            return

        def split(left, shard, held, room):
            if shard == len(room):
                if not left:
                    lay(k + 1, room, cut + held - 1)
                return
            for take in range(min(left, room[shard]), -1, -1):
                split(left - take, shard + 1, held + (take > 0), [*room[:shard], room[shard] - take, *room[shard + 1 :]])

        split(sizes[k], 0, 0, room)

    lay(0, list(capacity), 0)
    return best[0]


@pytest.mark.parametrize("sizes", [(4, 4, 4), (6, 3, 3), (5, 4, 2, 1), (7, 2, 2), (3, 3, 3, 2)])
def test_the_cut_is_within_three_of_the_best_one(spark, sizes):
    """Half of the rows are linked with none; full of linked rows, shards have no room to move in and more is cut."""
    linked = [f"group {g}" for g, s in enumerate(sizes) for _ in range(s)]
    texts = linked + [f"alone {k}" for k in range(len(linked))]
    n = len(texts)
    rows = list(enumerate(random.Random(3).sample(texts, n)))
    capacity = [n // 3 + (t < n % 3) for t in range(3)]
    assert sum(cuts(placed(spark, rows, 3)).values()) <= least_cut(sizes, capacity) + 3


def test_propagation_goes_on_as_long_as_the_cut_falls(spark):
    rng = random.Random(8)
    rows = [(i, "hot" if i % 3 == 0 else f"t{rng.randrange(300)}") for i in range(1500)]
    out = [sum(cuts(placed(spark, rows, 12, patience=p)).values()) for p in (1, 10)]
    assert out[1] <= out[0] and out[1] < 60  # of 1,000 rows in groups of three; nothing is unlinked
