"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio.

Each text is a bag of hashed word unigrams and bigrams. Two multinomials over
``BUCKETS`` buckets are counted: one of the whole corpus (every row), one of
the trusted target (every labelled row of good quality that is not toxic). A text's score is
the mean log ratio of the two over its n-grams, so length cancels out; every
text below the threshold is rejected, with no sampling of the decision. The
target is smoothed towards the corpus by ``PRIOR`` pseudo n-grams: buckets the
target knows little of weigh little, and without trusted rows every score is 0.

Scores shrink towards 0 as buckets fill, so the threshold is found anew at each
run: the best split of the scores of all trusted and all rejected rows, each
trusted row scored without its own n-grams in the target. Without rows of both kinds, or a split
that helps, it is ``MIN_SCORE``.

Only DataFrame functions run here. Counting, judging and scoring are one scan each:
the counts meet in one partial aggregation over the buckets, the rounded scores
of judged rows in another, so neither judging nor scoring shuffles n-grams. The bounded tables
(``BUCKETS`` numbers) are a broadcast table and a scalar subquery: as literals they would be
written out in every description of the plan, which the driver keeps. Labelled ids are
broadcast while they are few (``broadcast_if_small``), else joined by a shuffle.

Defined results: null is an empty text; a text without words has score 0,
zero counts and fails the base rules; rows repeating a ``doc_id`` are judged
each by its own text; a label with a null quality, and an id with
contradicting labels, is not trusted; input columns of any name are kept, but for
those named like the new ones. Repeated 3-word windows are found by sorted
hashes and confirmed word by word.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.once import computed_once
from ..sources.tables import broadcast_if_small

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BUCKETS = 1 << 16
PRIOR = 20_000
#: Threshold that labels do not decide: n-grams are on average less than half as likely in the target.
MIN_SCORE = -math.log(2)
#: Share of rejected rows that must go for each equal share of trusted rows lost.
LOST = 10
#: Decimals of the scores the threshold is chosen from (bounds what comes to the driver).
DIGITS = 3
#: Judged rows add up whole numbers of this part of 1, so that their scores do not depend on the order of n-grams.
UNIT = 1e9

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def _with_words(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return computed_once(docs.withColumn("_text", text), "_words", words_of(F.col("_text")))


def _bucket(*gram: Column) -> Column:
    """Bucket of an n-gram (BUCKETS is a power of two)."""
    return F.xxhash64(*gram).bitwiseAND(F.lit(BUCKETS - 1).cast("bigint")).cast("int")


def _buckets(words: Column) -> Column:
    """Buckets of all unigrams and bigrams."""
    two = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda w, v: _bucket(w, v))
    return F.concat(F.transform(words, lambda w: _bucket(w)), two)


def _bucket_rows(df: DataFrame, *carried: str) -> DataFrame:
    """(*carried, bucket): a row for each unigram and each bigram of ``_words``."""
    words = F.col("_words")
    # A word and the one after it, in generated code (a lambda over the words is interpreted).
    pairs = F.arrays_zip(words.alias("word"), F.slice(words, 2, F.size(words)).alias("next"))
    grams = df.select(*carried, F.inline(pairs))
    two = F.when(F.col("next").isNotNull(), _bucket(F.col("word"), F.col("next")))
    return grams.select(*carried, F.explode(F.array(_bucket(F.col("word")), two)).alias("bucket")).filter("bucket IS NOT NULL")


def _prepared(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with columns that the statistics are made of, and the expressions of STATISTICS."""
    df = _with_words(docs)
    words, text, n = F.col("_words"), F.col("_text"), F.size("_words")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    df = df.withColumns({"_lines": lines, "_bits": F.length(F.bin(n.cast("bigint")))})
    short = F.greatest(n - 2, F.lit(0))
    two = F.zip_with(F.slice(words, 1, short), F.slice(words, 2, short), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_grams", F.zip_with(two, F.slice(words, 3, short), lambda h, c: F.xxhash64(h, c)))
    # Texts whose hashes all differ repeat no window; only the others are sorted.
    repeating = F.size(F.array_distinct("_grams")) < F.size("_grams")
    grams = F.when(repeating, F.col("_grams")).otherwise(F.array().cast("array<bigint>"))
    # One number per 3-word window: its hash above, its position in the low bits.
    packed = F.transform(grams, lambda g, i: F.call_function("shiftleft", g, F.col("_bits")).bitwiseOR(i.cast("bigint")))
    df = df.withColumn("_packed", packed).withColumn("_sorted", F.sort_array("_packed"))
    s, bits = F.col("_sorted"), F.col("_bits")

    def window(x: Column) -> Column:
        return F.call_function("shiftrightunsigned", x, bits)

    low = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1

    def same(x: Column, y: Column) -> Column:
        """Equal hashes, and then equal words: what the position's bits took from the hash does not matter."""
        a, b = x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")
        equal = [F.get(words, a + k) == F.get(words, b + k) for k in range(3)]
        return F.coalesce((window(x) == window(y)) & equal[0] & equal[1] & equal[2], F.lit(False))

    twice = F.filter(s, lambda x, i: ((i > 0) & same(x, F.get(s, i - 1))) | same(x, F.get(s, i + 1)))
    df = df.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(low))))
    at = F.col("_at")
    gaps = F.transform(at, lambda p, i: F.when(i > 0, F.least(F.lit(3).cast("bigint"), p - F.get(at, i - 1))).otherwise(F.lit(3).cast("bigint")))
    repeat = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df, {
        "n_words": n.cast("bigint"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": repeat,
    }


def judged_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, good): 1 for every id whose labels all say good quality and none toxic, 0 for every id whose labels all say bad quality."""
    trusted = (F.min(F.coalesce("quality", F.lit(0))) == 1) & (F.max(F.coalesce("toxic", F.lit(0))) == 0)
    rejected = F.max(F.coalesce("quality", F.lit(1))) == 0
    ids = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.when(trusted, F.lit(1)).when(rejected, F.lit(0)).alias("good"))
    return ids.filter("good IS NOT NULL")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids whose every label says good quality and none says toxic."""
    return judged_ids(labels).filter("good = 1").select("doc_id")


def rejected_ids(labels: DataFrame) -> DataFrame:
    """All ids whose every label says bad quality."""
    return judged_ids(labels).filter("good = 0").select("doc_id")


def bucket_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, n_corpus, n_target) over all rows of ``docs``."""
    trusted = broadcast_if_small(trusted_ids(labels).withColumn("_trusted", F.lit(1)))
    marked = docs.select("doc_id", "text").join(trusted, "doc_id", "left")
    return _bucket_rows(_with_words(marked), "_trusted").groupBy("bucket").agg(F.count("*").alias("n_corpus"), F.count("_trusted").alias("n_target"))


def counted(counts: DataFrame) -> tuple[list[float], list[int]]:
    """Smoothed corpus share and target count of every bucket; at most BUCKETS rows come to the driver."""
    corpus, target = [0.5] * BUCKETS, [0] * BUCKETS
    for r in counts.collect():
        corpus[r["bucket"]] += r["n_corpus"]
        target[r["bucket"]] = r["n_target"]
    n_corpus = sum(corpus)
    return [c / n_corpus for c in corpus], target


def weights(shares: list[float], target: list[int]) -> list[float]:
    """Log ratio of every bucket."""
    n_target = sum(target)
    return [math.log((t + PRIOR * p) / (n_target + PRIOR) / p) for t, p in zip(target, shares, strict=True)]


def _table(spark: SparkSession, weight: list[float]) -> Column:
    """All weights, as a scalar subquery over one row."""
    numbers = pa.array([[float(format(x, ".5f")) for x in weight]], pa.list_(pa.float64()))
    return spark.createDataFrame(pa.table({"weight": numbers})).scalar()


def score(words: Column, table: Column) -> Column:
    """Mean weight of a text's n-grams (0 without words)."""

    def total(weight: Column) -> Column:
        # A unigram and the bigram it begins, together. After the last word comes null, which hashes
        # leave out: that word's own bucket is then counted twice, and taken off again.
        both = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda w, v: F.get(weight, _bucket(w)) + F.get(weight, _bucket(w, v)))
        return F.aggregate(both, F.lit(0.0), lambda a, x: a + x) - F.get(weight, _bucket(F.get(words, F.size(words) - 1)))

    # The table goes by reference, as the one element of an array.
    summed = F.get(F.transform(F.array(table), total), F.lit(0))
    return F.when(F.size(words) == 0, F.lit(0.0)).otherwise(summed / (2 * F.size(words) - 1))


def judged_scores(docs: DataFrame, labels: DataFrame, shares: list[float], target: list[int]) -> DataFrame:
    """(good, score, n): rounded scores of all judged rows that are long enough, and how many rows have them.

    A trusted row is scored as if it were not in the target. A row's n-grams are
    counted as runs of its sorted buckets, in the row; only sums by row are shuffled.
    """
    known = docs.select("doc_id", "text").join(broadcast_if_small(judged_ids(labels)), "doc_id")
    known = known.select("good", "text", F.monotonically_increasing_id().alias("_row"))
    known = _with_words(known).filter(F.size("_words") >= MIN_WORDS)
    known = computed_once(known.select("_row", "good", "_words"), "_s", F.sort_array(_buckets(F.col("_words")))).select("_row", "good", "_s")
    s, n = F.col("_s"), F.size("_s")
    # Where runs of equal buckets end, counted from 1, and how long they are.
    more = F.zip_with(s, F.slice(s, 2, n), lambda x, y: x.eqNullSafe(y))
    ends = F.array_remove(F.zip_with(F.sequence(F.lit(1), n), more, lambda i, more: F.when(more, F.lit(0)).otherwise(i)), 0)
    known = computed_once(known, "_ends", ends)
    starts = F.concat(F.array(F.lit(0)), F.slice("_ends", 1, F.size("_ends") - 1))
    runs = known.select("_row", "good", "_s", F.inline(F.arrays_zip(F.col("_ends").alias("end"), starts.alias("start"))))
    runs = runs.select("_row", "good", F.get("_s", F.col("end") - 1).alias("bucket"), (F.col("end") - F.col("start")).alias("c"))
    numbers = pa.table({"bucket": pa.array(range(BUCKETS), pa.int32()), "share": pa.array(shares, pa.float64()), "count": pa.array(target, pa.int64())})
    runs = runs.join(F.broadcast(docs.sparkSession.createDataFrame(numbers)), "bucket")
    c, good, p = F.col("c"), F.col("good"), F.col("share")
    weight = c * F.log((F.col("count") - good * c + PRIOR * p) / p)
    rows = runs.groupBy("_row", "good").agg(F.sum(F.rint(weight * UNIT).cast("bigint")).alias("total"), F.sum("c").alias("length"))
    scored = F.col("total") / UNIT / F.col("length") - F.log(sum(target) - good * F.col("length") + F.lit(float(PRIOR)))
    return rows.groupBy("good", F.round(scored, DIGITS).alias("score")).agg(F.count("*").alias("n"))


def best_split(scores: list[tuple[int, float, int]]) -> float:
    """Threshold between two neighbouring scores of (good, score, n) where the share of rejected rows below it,
    less LOST times the share of trusted ones, is largest; MIN_SCORE if no split gains."""
    rows = [sum(n for g, _, n in scores if g == good) for good in (0, 1)]
    if not all(rows):
        return MIN_SCORE
    values = sorted({x for _, x, _ in scores})
    gains = dict.fromkeys(values, 0.0)
    for good, x, n in scores:
        gains[x] += -LOST * n / rows[1] if good else n / rows[0]
    best, threshold, gain = 1e-9, MIN_SCORE, 0.0
    for x, above in zip(values, [*values[1:], None], strict=True):
        gain += gains[x]
        if gain > best and above is not None:
            best, threshold = gain, (x + above) / 2
    return threshold


def quality(docs: DataFrame, labels: DataFrame, min_score: float | None = None) -> DataFrame:
    """All columns of ``docs`` with STATISTICS, base_failed, score and kept.

    ``docs`` needs doc_id and text; its columns named like the new ones are
    replaced. ``min_score`` is used instead of the threshold that the labels give.
    """
    shares, target = counted(bucket_counts(docs, labels))
    weight = weights(shares, target)
    if min_score is None:
        min_score = best_split([tuple(r) for r in judged_scores(docs, labels, shares, target).collect()])
    # Input columns go by names that no work column has, and get their own back at the end.
    new = [*STATISTICS, "score", "base_failed", "kept"]
    carried = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c not in new and c != "text"}
    bare = docs.select("text", *[F.col(f"`{c}`").alias(name) for c, name in carried.items()])
    df, found = _prepared(bare)
    # A column first, as lambdas may hold no subquery; used once, it is never written to a row.
    df = df.withColumn("_weights", _table(docs.sparkSession, weight)).withColumn("_score", score(F.col("_words"), F.col("_weights")))
    found["score"] = F.col("_score")
    # A one-element inline keeps these as plain columns above it: a filter on
    # them must not carry the expressions (with arrays sorted inside) below.
    once = F.inline(F.array(F.struct(*[e.alias(c) for c, e in found.items()])))
    df = df.select(*bare.columns, once)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    df = df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= min_score))
    own = [F.col("text") if c == "text" else F.col(carried[c]).alias(c) for c in docs.columns if c not in new]
    return df.select(*own, *new)
