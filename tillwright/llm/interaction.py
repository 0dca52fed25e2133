"""Filter interaction audit: what each order of five filters removes, from additive mask counts.

Every document fails some of the filters A to E; the failures are a mask of
five bits. All 120 orders, redundancies and Shapley sums are functions of how
many documents of a part have each mask, so documents are counted once and
orders never meet documents.

E (the text of a smaller ``doc_id``) is the only filter that looks at other
rows. A counting Bloom prepass keeps most texts out of the shuffle: the text
hash picks a block of ``CELLS`` counters and ``PROBES`` cells of it; partial counts
merge map-side, so a text that a third of all rows hold is one addend of each
task. A text with a cell that counted once is unique for certain. Only texts
whose cells all counted twice or more are grouped, by the full text, for their
smallest id. A row in such a group is a repeat if it is not the group's
smallest (id, hash); that pair is nearly unique, so the flag joins on no hot key.

A sketch holds ``ROWS_PER_BLOCK`` rows a block and ``SLICE_BLOCKS`` blocks, which
bounds what is broadcast (64 bytes a block). Beyond that many rows the hash
space is cut into slices of that size; texts are then written once, parted by
slice, and each slice is one pass over its own part.

Defined results: null text is empty, null lang is the part ''; an empty table
gives no rows; a row with a null ``doc_id`` has no smaller id and is no other
row's smaller id, so it never fails E; rows repeating the smallest id and its
text do not fail E; a document is good (toxic) if any label of its id says so;
only doc_id, text and lang are read, other columns may have any name.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import dropped, staged, staged_at
from .quality import words_of

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
SYMBOLS = "[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Counters of a block: eight words of 64 bits once only "twice or more" is kept.
CELLS = 512
WORDS = CELLS // 64
PROBES = 3
#: Rows a block is made for: about 3 % of unique texts then look like repeats.
ROWS_PER_BLOCK = 64
#: Blocks of one broadcast sketch (64 bytes each, 32 MB in all).
SLICE_BLOCKS = 1 << 19


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = words_of(text)
    n, upper = F.size(words), F.length(text) - F.length(F.translate(text, UPPER, ""))
    failed = [
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n,
        100 * upper.cast("bigint") > MAX_UPPER_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0)).cast("int")


def _block(blocks: int) -> Column:
    return F.shiftrightunsigned("h", 32) % F.lit(blocks)


def _cells() -> list[Column]:
    """The cells of a text in its block."""
    return [F.pmod(F.shiftrightunsigned("h", 9 * i).bitwiseAND(F.lit(CELLS - 1)), F.lit(CELLS)).cast("int") for i in range(PROBES)]


def sketch(hashes: DataFrame, blocks: int) -> DataFrame:
    """(block, words): bit c of a block says that its cell c counted twice or more. Blocks without such cells have no row.

    ``hashes``: (h, n) with n rows of hash h. The cells of one text may coincide; each text adds to a cell once.
    """
    cells = hashes.select(_block(blocks).alias("block"), F.explode(F.array_distinct(F.array(*_cells()))).alias("cell"), "n")
    counts = cells.groupBy("block", "cell").agg(F.sum("n").alias("n")).filter("n > 1")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("cell") % 64)
    words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("cell") / 64) == w, bit)), F.lit(0).cast("bigint")) for w in range(WORDS)]
    return counts.groupBy("block").agg(F.array(*words).alias("words"))


def possible_repeats(rows: DataFrame, open_cells: DataFrame, blocks: int) -> DataFrame:
    """Rows (with hash ``h``) whose cells all counted twice or more."""
    found = rows.join(F.broadcast(open_cells.withColumnRenamed("block", "_block")), _block(blocks) == F.col("_block"))
    for cell in _cells():
        word = F.get(F.col("words"), F.floor(cell / 64).cast("int"))
        found = found.filter(F.call_function("shiftrightunsigned", word, cell % 64).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return found.drop("_block", "words")


def repeat_counts(docs: DataFrame, flags: DataFrame, slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """(doc_id, part, mask, n): rows of ``flags`` (doc_id, part, mask, h) counted, with the bit of E where it holds.

    ``docs``: (doc_id, text), the same rows.
    """
    spark = docs.sparkSession
    blocks = max(1, -(-flags.count() // ROWS_PER_BLOCK))
    slices = -(-blocks // slice_blocks)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    which = F.pmod(F.xxhash64("h"), F.lit(slices))
    if slices > 1:
        path = scratch_path(spark, "llm-slices")
        texts.withColumn("slice", which).write.partitionBy("slice").parquet(path)
        texts = spark.read.parquet(path)
    out, blocks = [], min(blocks, slice_blocks)
    for k in range(slices):
        mine, their = flags.filter(which == k), texts.filter(F.col("slice") == k) if slices > 1 else texts
        mine = mine.groupBy("doc_id", "part", "mask", "h").agg(F.count("*").alias("n"))
        open_cells, at = staged_at(sketch(mine.select("h", "n"), blocks), "open-cells")
        first = possible_repeats(their.select("doc_id", "text", "h"), open_cells, blocks).groupBy("text").agg(F.min("doc_id").alias("_id"))
        first = first.select("_id", F.xxhash64("text").alias("_h")).filter("_id IS NOT NULL").distinct().withColumn("_first", F.lit(1))
        maybe = possible_repeats(mine, open_cells, blocks).filter("doc_id IS NOT NULL")
        repeats = maybe.join(first, (F.col("doc_id") == F.col("_id")) & (F.col("h") == F.col("_h")), "left").filter("_first IS NULL")
        counted = mine.select("doc_id", "part", "mask", "n").unionAll(
            # A repeat moves from its mask to the mask with E: minus here, plus there.
            repeats.select("doc_id", "part", F.explode(F.array(F.struct("mask", (-F.col("n")).alias("n")), F.struct((F.col("mask") + 16).alias("mask"), "n"))).alias("m"))
            .select("doc_id", "part", "m.mask", "m.n")
        )
        counted, _ = staged_at(counted.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).filter("n > 0"), "masks")
        out.append(counted)
        dropped(spark, at)
    if slices > 1:
        dropped(spark, path)
    counted = out[0]
    for other in out[1:]:
        counted = counted.unionByName(other)
    return counted


def mask_counts(docs: DataFrame, labels: DataFrame, slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """(part, mask, n, good, toxic) of ``docs`` (doc_id, text, lang): at most 32 masks a part."""
    text = F.coalesce("text", F.lit(""))
    flags = staged(
        docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_mask(text).alias("mask"), F.xxhash64(text).alias("h")), "flags"
    )
    ids = labels.groupBy("doc_id").agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("bigint")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("bigint")).alias("toxic")
    )
    counted = repeat_counts(docs, flags, slice_blocks).join(ids, "doc_id", "left")
    sums = {c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")}
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums.values())


def order_audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of FILTERS and step, from :func:`mask_counts`."""
    orders = F.split(F.lit(" ".join("".join(p) for p in permutations(FILTERS))), " ")
    rows = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    rows = rows.select("part", "masks", F.explode(orders).alias("filter_order"))
    rows = rows.select("part", "masks", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    earlier = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    bits = [(1 << i, name) for i, name in enumerate(FILTERS)]
    rows = rows.withColumn("bit", sum((F.when(letter == name, b).otherwise(0) for b, name in bits), F.lit(0)))
    rows = rows.withColumn("before", sum((F.when(F.contains(earlier, F.lit(name)), b).otherwise(0) for b, name in bits), F.lit(0)))

    def total(holds, value) -> Column:
        return F.aggregate(F.filter("masks", holds), F.lit(0).cast("bigint"), lambda a, m: a + value(m))

    def has(m: Column, what: str) -> Column:
        return m["mask"].bitwiseAND(F.col(what)) != 0

    def n(m: Column) -> Column:
        return m["n"]

    def here(m: Column) -> Column:
        return has(m, "bit") & ~has(m, "before")

    # A mask of k failures is removed by each of its filters in 120 / k of the orders.
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda m: ~has(m, "bit") & ~has(m, "before"), n).alias("kept"),
        total(here, n).alias("removed"),
        total(lambda m: has(m, "bit") & has(m, "before"), n).alias("redundant"),
        total(lambda m: m["mask"] == F.col("bit"), n).alias("unique_fails"),
        total(here, lambda m: m["good"]).alias("good_lost"),
        total(here, lambda m: m["toxic"]).alias("toxic_lost"),
        total(lambda m: has(m, "bit"), lambda m: m["n"] * F.floor(F.lit(120) / F.bit_count(m["mask"]))).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """part, filter_order, step and the seven counts, for every order of the filters over ``docs`` (doc_id, text, lang)."""
    docs = docs.select("doc_id", "text", "lang")
    return order_audit(mask_counts(docs, labels, slice_blocks))
