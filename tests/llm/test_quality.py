"""Quality rules against brute force in Python."""

import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tillwright.llm import quality


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def statistics(text):
    text, w = text or "", words(text)
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + i for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for i in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def buckets(w):
    def h(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64(p.encode(), seed=seed).intdigest()
        return (seed - (1 << 64) if seed >> 63 else seed) % quality.BUCKETS

    return [h(x) for x in w] + [h(a, b) for a, b in zip(w, w[1:], strict=False)]


def scores(rows, trusted):
    corpus, target = Counter(), Counter()
    for doc_id, text in rows:
        corpus.update(buckets(words(text)))
        if doc_id in trusted:
            target.update(buckets(words(text)))
    n, m = sum(corpus.values()) + 0.5 * quality.BUCKETS, sum(target.values())

    def weight(b):
        share = (corpus[b] + 0.5) / n
        return math.log((target[b] + quality.PRIOR * share) / (m + quality.PRIOR) / share)

    return [sum(map(weight, buckets(words(t)))) / max(1, len(buckets(words(t)))) for _, t in rows]


def corpus(seed):
    rng = random.Random(seed)
    good, bad = [f"good{i}" for i in range(40)], [f"bad{i}" for i in range(40)]
    rows = []
    for d in range(80):
        n = rng.choice([0, 1, 2, 3, 20, 49, 50, 51, 200])
        source = bad if d % 4 == 0 else good
        w = [rng.choice(source) + rng.choice(["", "", ",", "|", "é#"]) for _ in range(n)]
        rows.append((d, "".join(x + rng.choice([" ", "\n", " \t", "\n\n", "\x0b"]) for x in w)))
    return rows


EDGES = [
    (None, "a b c"), (200, None), (201, ""), (202, " \n\x0b "), (203, "x x x x"), (203, "x x x x"), (204, "a b c a b c"), (205, "a\na\n\na \n"),
    (206, "w " * 30000), (207, " ".join(f"u{k}" for k in range(60))), (208, "same line here\nsame line here\nother"), (209, "\x1c\x85\xa0 中 文"),
]


@pytest.mark.parametrize("seed", [1])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(quality, "PRIOR", 100)  # few trusted n-grams here
    rows = corpus(seed) + EDGES
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit("clash"), "lang": F.lit("en")}).repartition(4)
    labels = [(d, 0 if d % 4 == 0 else 1, 0) for d in range(60)] + [(5, 0, 0), (6, None, None), (None, 1, 0), (9, 1, 0)]
    trusted = {d for d in range(60) if d % 4} - {5, 6}
    got = quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = []
    for (doc_id, text), score in zip(rows, scores(rows, trusted), strict=True):
        s = statistics(text)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want.append((doc_id, *s, failed, not failed and score >= quality.MIN_SCORE, round(score, 3)))
    have = [(r["doc_id"], *(r[c] for c in quality.STATISTICS), r["base_failed"], r["kept"], round(r["score"], 3)) for r in got]
    for a, b in zip(sorted(have, key=str), sorted(want, key=str), strict=True):
        assert a[:-1] == b[:-1] and abs(a[-1] - b[-1]) < 0.002
    assert {r["lang"] for r in got} == {"en"}
    judged = {r["doc_id"]: r["kept"] for r in got if not r["base_failed"]}
    assert not any(k for d, k in judged.items() if d and d < 80 and d % 4 == 0) and all(k for d, k in judged.items() if d and d < 80 and d % 4)


def test_empty_tables(spark):
    none, labels = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality(none, labels).count() == 0
    (row,) = quality.quality(spark.createDataFrame([(1, "a b " * 40 + " ".join(f"c{k}" for k in range(100)))], none.schema), labels).collect()
    assert row["kept"] and row["score"] == 0


def test_held_out_labels(spark):
    """Junk of the given tables goes, good documents stay."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    known = labels.filter("doc_id % 2 = 0")
    judged = quality.quality(docs, known).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("n_words >= 50")
    good = judged.filter("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    junk = judged.filter("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.98 and junk < 0.35


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_held_out_labels_at_any_size(spark, size):
    """The threshold follows the corpus: junk goes at each size."""
    d = f"/root/testdata/{size}"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    judged = quality.quality(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed")
    kept = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    print(size, kept)
    assert kept[1] > 0.98 and kept[0] < 0.2


def test_best_split():
    assert quality.best_split([(1, 0.2, 50), (1, 0.1, 50), (0, -0.1, 9), (0, 0.2, 1)]) == 0.0
    assert quality.best_split([(1, 0.2, 5)]) == quality.best_split([(1, 0.1, 5), (0, 0.3, 5)]) == quality.MIN_SCORE


def test_toxic_rows_are_no_target(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 1, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r[0] for r in quality.trusted_ids(labels).collect()} == {1, 3}


def test_columns_named_like_work_columns_are_kept(spark):
    text = " ".join(f"w{k}" for k in range(60))
    names = ["_text", "_words", "_lines", "_bits", "_packed", "_sorted", "_at", "_in0", "bucket"]
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string").withColumns({n: F.lit(f"mine {n}") for n in names})
    out = quality.quality(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] == text and rows[2]["text"] is None and rows[1]["n_words"] == 60
    assert all(r[n] == f"mine {n}" for r in rows.values() for n in names)


def test_windows_with_few_hash_bits_are_confirmed_by_words(spark, monkeypatch):
    """With all hashes equal, only words that are equal count as repeated."""
    real = F.xxhash64
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: real(*c) * 0)
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c a b c")], "doc_id long, text string")
    df, found = quality._prepared(docs)
    got = {r["doc_id"]: r["n"] for r in df.select("doc_id", found["n_repeat_words"].alias("n")).collect()}
    assert got[1] == 0


def test_all_labelled_ids_are_used(spark):
    labels = spark.range(27_500).select(F.col("id").alias("doc_id"), (F.col("id") < 25_000).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    assert quality.trusted_ids(labels).count() == 25_000 and quality.rejected_ids(labels).count() == 2_500


def test_judged_scores_leave_a_rows_own_ngrams_out(spark, monkeypatch):
    monkeypatch.setattr(quality, "PRIOR", 100)
    rows = corpus(3)
    docs, good = spark.createDataFrame(rows, "doc_id long, text string"), {d for d, _ in rows if d % 4}
    labels = spark.createDataFrame([(d, int(d in good), 0) for d, _ in rows], "doc_id long, quality int, toxic int")
    shares, target = quality.counted(quality.bucket_counts(docs, labels))
    got = Counter({(r["good"], r["score"]): r["n"] for r in quality.judged_scores(docs, labels, shares, target).collect()})
    want = Counter()
    for d, text in rows:
        own, g = buckets(words(text)), int(d in good)
        if len(words(text)) >= quality.MIN_WORDS:
            c, rest = Counter(own), sum(target) - g * len(own) + 100
            want[g, round(sum(math.log((target[b] - g * c[b] + 100 * shares[b]) / rest / shares[b]) for b in own) / len(own), 3)] += 1
    assert sum(got.values()) == sum(want.values())
    assert all(abs(a[1] - b[1]) < 0.002 and a[0] == b[0] for a, b in zip(sorted(got.elements()), sorted(want.elements()), strict=True))


def test_plans_do_not_spell_out_the_tables(spark):
    """A table of all buckets written out in the plan is kept by the driver once for each description of it."""
    docs = spark.createDataFrame([(1, "a b " * 40), (2, "c d " * 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    numbers = [1 / quality.BUCKETS] * quality.BUCKETS, [1] * quality.BUCKETS
    for df in (quality.quality(docs, labels), quality.judged_scores(docs, labels, *numbers)):
        df.collect()
        assert len(df._jdf.queryExecution().toString()) < 200_000
