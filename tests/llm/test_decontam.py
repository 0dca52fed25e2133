"""Benchmark decontamination against brute force."""

import hashlib
import random
import re
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from tillwright.llm import decontam

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(10, len(v))
            for p in range(len(v) - n + 1) if n else ():
                for q in range(len(w) - n + 1):
                    if w[q : q + n] == v[p : p + n]:
                        hit.update(range(q, q + n))
                        found.add("null" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def found(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"items": F.lit("clash"), "_n": F.lit(7), "extra": F.lit(1)}).repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return decontam.search(d, b, **more)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)]
    docs = []
    for d in range(40):
        parts = [rng.choice(vocabulary + ["É", "z9"]) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            item = rng.choice(items)[1].split()
            a = rng.randint(0, len(item) - 1)
            parts[rng.randint(0, len(parts)) : 0] = item[a : a + rng.randint(5, 30)]
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(parts).upper() if d % 4 == 0 else " ".join(parts)))
    return docs, items


EDGES = [(100, None), (101, ""), (102, "...,,"), (103, "w1"), (104, "W1 w1 w1"), (104, "W1 w1 w1"), (None, "w2 w3"), (105, "w1 " * 20000)]


def test_hits_equal_brute_force(spark):
    for seed in (1, 2):
        docs, items = corpus(seed)
        docs, items = docs + EDGES[:-1], items + [(50, None), (51, " . "), (None, "w7 w8"), (3, items[3][1]), (60, "w5")]
        want = brute(docs, items)
        assert sorted(map(tuple, found(spark, docs, items).select(COLUMNS).collect()), key=str) == want
        # The benchmark in blocks of one item each.
        assert sorted(map(tuple, found(spark, docs, items[:3], block_bytes=1).select(COLUMNS).collect()), key=str) == brute(docs, items[:3])


def test_longest_matches_and_their_places(spark):
    item = " ".join(f"i{k}" for k in range(30))
    text = "a b " + " ".join(item.split()[4:22]) + " c " + " ".join(item.split()[:9])
    (row,) = found(spark, [(1, text)], [(7, item)]).collect()
    assert [tuple(m) for m in row["matches"]] == [("7", 4, 2, 18)]
    assert row["extra"] == 1


def test_long_text_and_empty_tables(spark):
    (row,) = found(spark, [EDGES[-1]], [(1, "w1 w1 w1")]).collect()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (20000, 20000, True)
    (row,) = found(spark, [(1, "a b")], []).collect()
    assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (2, 0, 0, False)
    assert found(spark, [], [(1, "a")]).count() == 0


def test_repetitive_texts_against_repetitive_items(spark):
    rng = random.Random(6)
    docs = [(d, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 80)))) for d in range(30)] + [(40, "a b " * 60), (41, "a " * 200)]
    items = [(1, "a " * 40), (2, "a b " * 25), (3, " ".join(rng.choice("ab") for _ in range(30))), (4, "b a b")]
    assert sorted(map(tuple, found(spark, docs, items).select(COLUMNS).collect()), key=str) == brute(docs, items)


def test_a_million_equal_words_stay_in_bounds():
    """A text of 1,000,000 equal words and an item of 10,000: about as many matches as words, no list of pairs."""
    batch = pa.RecordBatch.from_pydict({"text": ["x " * 1_000_000]}, pa.schema([("text", pa.string())]))
    benchmark = decontam.Blocks(1, lambda k: (pa.array(["i"]), ["x " * 10_000]))
    tracemalloc.start()
    (out,) = decontam._search(benchmark)([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out["_hit"].to_pylist() == [1_000_000] and len(out["_matches"].values) == 1_009_981
    assert peak < 1 << 30


def test_blocks_beyond_those_held_and_one_stage_for_any_number(spark):
    docs, items = corpus(5)
    items = [(i, text) for i, (_, text) in enumerate(items * 2)] + [(90, None), (91, "")]
    assert len(items) > decontam.HELD_BLOCKS
    out = found(spark, docs, items, block_bytes=1)
    assert sorted(map(tuple, out.select(COLUMNS).collect()), key=str) == brute(docs, items)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_blocks_are_bounded_and_read_one_at_a_time(spark):
    items = [(i, f"w{i} " * 100) for i in range(40)] + [(40, "long " * 1000)]
    blocks = decontam.packed(spark.createDataFrame(items, "item_id long, text string"), 600)
    sizes, seen = [], []
    for k in range(blocks.count):
        ids, texts = blocks.load(k)
        sizes.append(sum(len(t) for t in texts[:-1]))
        seen += ids.to_pylist()
    assert sorted(seen, key=int) == [str(i) for i, _ in items] and max(sizes) < 600
    assert len(list(blocks)) == blocks.count and len(blocks.held) == decontam.HELD_BLOCKS
