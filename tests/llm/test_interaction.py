"""Filter interaction audit against brute force over the orders."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tillwright.llm import interaction

SPACED = "[^\x20\x09-\x0d]+"


def fails(rows):
    """The set of failed filters of each row (doc_id, text, lang)."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(SPACED, text)
        smaller = any(d is not None and doc_id is not None and d < doc_id and (t or "") == text for d, t, _ in rows)
        checks = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": smaller,
        }
        out.append({k for k, v in checks.items() if v})
    return out


def brute(rows, labels):
    failed, out = fails(rows), []
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    for part in {lang or "" for _, _, lang in rows}:
        mine = [(d, f) for (d, _, lang), f in zip(rows, failed, strict=True) if (lang or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for _, f in mine:
                first = next((x for x in order if x in f), None)
                if first:
                    shapley[first] += 1
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                redundant = sum(x in f for _, f in mine) - len(gone)
                unique = sum(f == {x} for _, f in mine)
                out.append((part, "".join(order), step, len(left), len(gone), redundant, unique, sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), shapley[x]))
    return sorted(out)


def hard_rows(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "#", "ÀÉ 𝒜 ABC", "a " * 300, "A " * 30, "x" * 50000, " ".join(f"w{k}" for k in range(400)), "é é é"]
    texts += [" ".join(rng.choice("abcDE#") * rng.randint(1, 3) for _ in range(rng.randint(0, 260))) for _ in range(20)]
    rows = [(rng.choice([*range(60), None]), rng.choice(texts), rng.choice(["en", "", None, "é"])) for _ in range(150)]
    rows += [(100 + k, "hot", "en") for k in range(80)] + [(7, "hot", "en")] * 3
    labels = [(rng.choice([*range(110), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    return rows, labels


@pytest.mark.parametrize("slice_blocks", [interaction.SLICE_BLOCKS, 1])
def test_audit_equals_brute_force(spark, slice_blocks):
    rows, labels = hard_rows(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"mask": F.lit("clash"), "h": F.lit(1)}).repartition(5)
    got = interaction.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), slice_blocks)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, labels)


def test_sketch_passes_every_repeat_and_few_others(spark):
    hashes = spark.range(20_000).select(F.xxhash64("id").alias("h"), F.when(F.col("id") < 50, 2).otherwise(1).cast("bigint").alias("n"))
    blocks = 20_000 // interaction.ROWS_PER_BLOCK
    found = interaction.possible_repeats(hashes, interaction.sketch(hashes, blocks), blocks)
    assert found.filter("n = 2").count() == 50
    assert found.filter("n = 1").count() < 0.08 * 20_000


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(docs, labels).count() == 0
    assert interaction.audit(spark.createDataFrame([(1, "a", "en")], docs.schema), labels).count() == 600
