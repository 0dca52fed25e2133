"""Near duplicates against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tillwright.llm import minhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n_shingles, component_id) of each row, links over all pairs of rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for k, (d, _) in enumerate(rows) if find(k) == find(i) and d is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids and sets[i] else doc_id))
    return out


def near_copies(seed, n_groups=12, copies=8):
    """Groups of near copies at many distances, some of equal texts, and passages that groups share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, doc = [], 0
    for g in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 30, 120]))] + (passage if g % 3 == 0 else [])
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((doc, " ".join(words)))
            doc += 1
    rng.shuffle(rows)
    return rows


EDGES = [
    (100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "ONE"), (105, "a b c d"), (106, "A B\nC D"), (107, "a b c d e"), (107, "a b c d e"),
    (108, "É b c d e f"), (109, "é b c d e f"), (None, "null id text here now"), (None, "null id text here now"), (110, "null id text here now"),
    (None, "only null ids in this one"), (111, "x " * 30000),
]


@pytest.mark.parametrize("seed", [1])
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed) + EDGES
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"label": F.lit("clash"), "fp": F.lit(1)}).repartition(5)
    got = [tuple(r) for r in minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_kept_marks_the_smallest_id(spark):
    docs = spark.createDataFrame([(5, "a b c d e f g"), (3, "a b c d e f g"), (9, "")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in minhash.near_duplicates(docs).collect()} == {5: False, 3: True, 9: True}


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_exact_threshold(spark):
    """100 * 3 >= 75 * 4 links; 100 * 2 >= 75 * 3 does not."""
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "p q r s t u"), (4, "p q r s t u v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_block_links_finds_links_that_no_centre_has(spark):
    """Two clusters that meet in one bucket: links among those that are far from the centre."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        far = list(range(0, 200, 9)) if i % 2 else []
        for k in far:
            words[k] = f"far{k}"
        for _ in range(2):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got) == sorted(brute(rows))


def test_chains_joined_by_one_block_link_are_whole(spark, monkeypatch):
    """Chains a-b and c-d whose only other link, b-c, is left to the blocks: all four are one component."""
    rng = random.Random(5)
    rows = []
    for g in range(8):
        a = [f"g{g}w{i}" for i in range(200)]
        for copy in range(4):
            rows.append((len(rows), " ".join(a + ["end"] * (copy > 1))))
            for k in range(4):
                a[10 + 50 * k + 11 * copy] = f"x{rng.randrange(10**9)}"
    want = brute(rows)
    assert sorted({c for _, _, c in want}) == list(range(0, 32, 4))
    by_centre = minhash._by_centre

    def apart(buckets, percent):  # pairs of sets of one size only: a-b and c-d
        n = buckets.select("cid", "n_shingles").distinct()
        return by_centre(buckets, percent).join(n.toDF("x", "n"), "x").join(n.toDF("y", "n"), ["y", "n"]).select("x", "y")

    monkeypatch.setattr(minhash, "_by_centre", apart)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got) == sorted(want)
