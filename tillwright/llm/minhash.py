"""Near duplicates by MinHash with tensored banding.

A text's set holds the hashes of its distinct 5-word shingles. Two small
collections of half keys (``HALVES`` each, of ``WIDTH`` minhashes) are
computed per set, and every pair of one left and one right half key is a
table key: 24 + 24 half keys stand for 576 tables of 6 minhashes, from 144
minhashes instead of 3,456. At similarity 0.75 a pair meets in no table with
probability 4e-6 (``2 * (1 - 0.75**3)**24``).

Only half keys that several sets share are paired, as a table key can be
shared only if both its halves are; and half keys shared by the very same sets
are paired once, as their tables have the same members. A bucket's centre is
the member whose half keys are shared most. Each set is first confirmed, on
the full sets, against the centre of the largest bucket it is in, which makes most
groups one component at one pair a set. A bucket whose members lie in one component is
closed; in the others, members of other components than the centre's are
confirmed against it. What is then open goes an exact way: a set can have a link to
another component only if 75 % of its shingles occur in other components;
sets that pass are gathered in clusters (joined by common left half keys), and
all sets of a cluster are compared block by block (at most
``BLOCK`` sets and ``BLOCK_SHINGLES`` shingles each) by matrix products, which emit links only. So no pair that met is left out, and
no group's pairs are listed.

Defined results: null is an empty text; texts without words have
``n_shingles`` 0 and stay alone; equal sets (copies) are one class whatever
their number; a null ``doc_id`` takes part, and ``component_id`` is the
smallest id that is not null; rows that repeat a ``doc_id`` are judged each by
its own text. Only the columns of id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum
from .common import buffer_of, dropped, map_batches, passes, ranked, staged, staged_at
from .components import components, merged

SHINGLE = 5
PERCENT = 75
HALVES = 24
WIDTH = 3
#: Sets of one cluster that are compared with as many others in one group.
BLOCK = 256
#: Shingles of one block; a single larger set is a block of its own.
BLOCK_SHINGLES = 1 << 20
#: Shingles that are min-hashed, or multiplied, at a time (bounds memory for very long texts).
CHUNK = 1 << 12

_SEEDS = textnum.mixed(np.arange(1, 2 * HALVES * WIDTH + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_MULTIPLIERS = textnum.mixed(_SEEDS) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles (fewer words: one hash of them all)."""
    hashes, _, _, first = textnum.words(data, offsets, textnum.SPACED)
    runs = textnum.window_hashes(hashes, width)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(runs[a : b - width + 1])
        elif b > a:
            yield textnum.window_hashes(hashes[a:b], int(b - a)) + np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def fingerprint(hashes: np.ndarray) -> bytes:
    """128 bits that tell sets apart, from a sum and a xor of differently mixed members."""
    with np.errstate(over="ignore"):
        total = textnum.mixed(hashes + np.uint64(0x9E37)).sum(dtype=np.uint64)
        folded = np.bitwise_xor.reduce(textnum.mixed(hashes * np.uint64(0xE7037ED1A0B428DB)), initial=np.uint64(len(hashes)))
    return np.array([total, folded], np.uint64).tobytes()


def half_keys(hashes: np.ndarray) -> np.ndarray:
    """The 2 * HALVES half keys of a set, left ones first."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(hashes), CHUNK):
            values = ((hashes[k : k + CHUNK, None] ^ _SEEDS) * _MULTIPLIERS).min(axis=0)
            least = np.minimum(least, values)
        keys = np.arange(2 * HALVES, dtype=np.uint64)
        for k in range(WIDTH):
            keys = textnum.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + least[k::WIDTH])
    return keys.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches, "text"):
        sizes, prints, keys = [], [], []
        for hashes in shingle_sets(*buffer_of(batch.column("text"))):
            sizes.append(len(hashes))
            prints.append(fingerprint(hashes))
            keys.append(half_keys(hashes) if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            ["doc_id", "text_key", "n_shingles", "fp", "keys"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches, "text"):
        prints, sets = [], []
        for hashes in shingle_sets(*buffer_of(batch.column("text"))):
            prints.append(fingerprint(hashes))
            sets.append(hashes.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["fp", "set"])


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x.values) for x in column]


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(_arrays(batch.column("set_x")), _arrays(batch.column("set_y")), strict=True):
                common = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _linked(percent: int):
    def link(table: pa.Table) -> pa.Table:
        """Pairs of components that sets of the blocks ``lo`` and ``hi`` of a cluster link, each once, by their labels."""
        table = table.combine_chunks()
        sets = _arrays(table.column("set").chunk(0)) if table.num_rows else []
        label = np.asarray(table.column("label"))
        n = np.array([len(x) for x in sets])
        left = np.flatnonzero(np.asarray(table.column("block")) == np.asarray(table.column("lo")))
        right = np.flatnonzero(np.asarray(table.column("block")) == np.asarray(table.column("hi")))
        owner = np.repeat(np.arange(len(sets)), n)
        distinct, inverse, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        column = np.cumsum(seen > 1) - 1
        shared = seen[inverse] > 1
        owner, column = owner[shared], column[inverse[shared]]
        common = np.zeros((len(left), len(right)), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for k in range(0, int(column[-1]) + 1 if len(column) else 0, CHUNK):
            i, j = np.searchsorted(column, [k, k + CHUNK])
            member = np.zeros((len(sets), CHUNK), np.float32)
            member[owner[i:j], column[i:j] - k] = 1
            common += member[left] @ member[right].T
        union = n[left][:, None] + n[right][None, :] - common
        x, y = np.nonzero((100 * common >= percent * union) & (label[left][:, None] != label[right][None, :]))
        pairs = np.unique(np.stack([label[left[x]], label[right[y]]], axis=1), axis=0)
        return pa.table({"x": pa.array(pairs[:, 0], pa.int64()), "y": pa.array(pairs[:, 1], pa.int64())})

    return link


def shared_halves(classes: DataFrame) -> DataFrame:
    """(cid, n_shingles, left, right, score) of ``classes`` (cid, n_shingles, keys) that share half keys of both sides.

    A half key stands for the sets that share it, so those of equal sets are
    one; the lowest bit of ``half`` is its side.
    """
    sides = F.transform("keys", lambda k, i: k.bitwiseAND(F.lit(-2).cast("bigint")).bitwiseOR((i >= HALVES).cast("bigint")))
    halves = classes.select("cid", F.explode(sides).alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cid")).alias("who")).filter("n > 1")
    shared = shared.select("half", "n", F.xxhash64("who", "n").alias("sharers"))
    side = F.col("half").bitwiseAND(F.lit(1).cast("bigint"))
    mine = (
        halves.join(shared, "half")
        .groupBy("cid")
        .agg(
            F.collect_set(F.when(side == 0, F.col("sharers"))).alias("left"),
            F.collect_set(F.when(side == 1, F.col("sharers"))).alias("right"),
            F.sum("n").alias("score"),
        )
        .filter((F.size("left") > 0) & (F.size("right") > 0))
    )
    return mine.join(classes.select("cid", "n_shingles"), "cid")


def table_keys(halves: DataFrame) -> DataFrame:
    """(key, cid, n_shingles, score): each pair of a left and a right half key."""
    pairs = F.flatten(F.transform("left", lambda a: F.transform("right", lambda b: F.xxhash64(a, b))))
    return halves.select(F.explode(pairs).alias("key"), "cid", "n_shingles", "score")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (x, y) whose full sets are similar enough."""
    with_x = pairs.join(sets.select(F.col("cid").alias("x"), F.col("set").alias("set_x")), "x")
    with_both = with_x.join(sets.select(F.col("cid").alias("y"), F.col("set").alias("set_y")), "y")
    return map_batches(with_both.select("x", "y", "set_x", "set_y"), _confirmed(percent), "x bigint, y bigint")


def _centres(buckets: DataFrame) -> DataFrame:
    """(key, a, n_a): each bucket's centre, the member of the highest score."""
    centre = buckets.groupBy("key").agg(F.max(F.struct("score", "cid", "n_shingles")).alias("c"))
    return centre.select("key", F.col("c.cid").alias("a"), F.col("c.n_shingles").alias("n_a"))


def _pairs(links: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (x, y) of links (a, n_a, cid, n_shingles) whose sizes allow the similarity."""
    fits = 100 * F.least("n_a", "n_shingles") >= percent * F.greatest("n_a", "n_shingles")
    return links.filter(fits & (F.col("a") != F.col("cid"))).select(F.least("a", "cid").alias("x"), F.greatest("a", "cid").alias("y")).distinct()


def _by_largest_bucket(buckets: DataFrame, percent: int) -> DataFrame:
    """One pair (x, y) for each set: with the centre of the largest bucket it is in."""
    largest = buckets.groupBy("cid", "n_shingles").agg(F.max(F.struct("n", "key")).alias("b")).select("cid", "n_shingles", F.col("b.key").alias("key"))
    return _pairs(largest.join(_centres(buckets), "key"), percent)


def _by_centre(buckets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (x, y) of the centre of each bucket (key, cid, n_shingles, score, label) with the members of other components than its own."""
    centres = _centres(buckets).join(buckets.select(F.col("cid").alias("a"), F.col("label").alias("label_a")).distinct(), "a")
    others = (buckets["key"] == centres["key"]) & (buckets["label"] != centres["label_a"])
    return _pairs(buckets.join(centres, others), percent)


def _ends(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (x, y) of sets with the labels of both, lx and ly."""
    x = labels.select(F.col("cid").alias("x"), F.col("label").alias("lx"))
    y = labels.select(F.col("cid").alias("y"), F.col("label").alias("ly"))
    return pairs.join(x, "x").join(y, "y")


def _open(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """``buckets`` with ``label``: those whose members lie in several components."""
    mine = buckets.join(labels, "cid")
    spread = mine.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("key")
    return mine.join(spread, "key")


def _block_links(still: DataFrame, halves: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Labels (x, y) of different components that are linked, from the sets of open buckets ``still`` (key, cid, label)."""
    inside = sets.join(still.select("cid", "label").distinct(), "cid")
    shingles = inside.select("cid", "label", F.explode("set").alias("s"))
    abroad = shingles.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("s")
    common = shingles.join(abroad, "s", "left_semi").groupBy("cid").agg(F.count("*").alias("n"))
    inside = inside.join(common, "cid").filter(100 * F.col("n") >= percent * F.size("set")).select("cid", "label", "set")
    inside = staged(inside, "inside")
    # Sets of one bucket share a left half key: those joined by left half keys are a cluster.
    keys = staged(halves.select("cid", F.explode("left").alias("key")).join(inside.select("cid"), "cid", "left_semi"), "left-keys")
    star = keys.join(keys.groupBy("key").agg(F.min("cid").alias("x")), "key").select("x", F.col("cid").alias("y")).filter("x != y").distinct()
    clusters = components(star).select(F.col("node").alias("cid"), F.col("label").alias("cluster"))
    # Blocks hold sets of one size class (powers of two), so that a block is bounded in shingles; linked sets lie in neighbouring classes.
    size = F.length(F.bin(F.size("set").cast("bigint")))
    laid = inside.select("cid", "label", size.alias("size")).join(clusters, "cid")
    laid = ranked(laid, ["cid"], ["cluster", "size"], "places", few_groups=False)
    hold = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_SHINGLES) / F.pow(F.lit(2), F.col("size")))))
    number = F.call_function("div", F.col("rank"), hold) + F.call_function("shiftleft", F.col("size").cast("bigint"), F.lit(40))
    places = laid.select("cid", "cluster", "size", "label", number.alias("block"))
    blocks = places.groupBy("cluster", "size", "block").agg(F.min("label").alias("first"), F.max("label").alias("last"))
    other = blocks.select("cluster", *[F.col(c).alias(f"{c}_b") for c in ("size", "block", "first", "last")])
    near = (F.col("block_b") >= F.col("block")) & (F.col("size_b") <= F.col("size") + 1)
    apart = F.least("first", "first_b") != F.greatest("last", "last_b")
    pairs = blocks.join(other, "cluster").filter(near & apart).select("cluster", F.col("block").alias("lo"), F.col("block_b").alias("hi"))
    meets = pairs.select("cluster", "lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("block"))
    meets = places.select("cid", "cluster", "block").join(meets, ["cluster", "block"])
    return meets.join(inside, "cid").groupBy("cluster", "lo", "hi").applyInArrow(_linked(percent), "x bigint, y bigint")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id,
    kept, ``set_key`` (the class of equal sets, hex), ``root_key`` (the set of
    the component's smallest id; the smallest one if that id has several) and
    ``text_key`` (``xxhash64`` of the row's text)."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    rows = map_batches(docs, _signatures, "doc_id bigint, text_key bigint, n_shingles bigint, fp binary, keys array<bigint>")
    rows = staged(rows, "signatures")
    classes = (
        rows.filter("n_shingles > 0")
        .groupBy("fp")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = staged(classes, "classes")
    halves = staged(shared_halves(classes), "halves")
    every, every_at = staged_at(table_keys(halves), "table-keys")
    shared = every.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = staged(every.join(shared, "key"), "buckets")
    dropped(docs.sparkSession, every_at)
    members = staged(buckets.select("cid").distinct().join(classes.select("cid", "fp", "rep"), "cid"), "members")
    texts = docs.join(members.select("rep").distinct(), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    # Classes are found by their sets, so rows that share an id, or lack one, do not mix.
    sets = map_batches(texts.select("text"), _sets, "fp binary, set array<bigint>").join(members.select("fp", "cid"), "fp")
    sets = staged(sets.dropDuplicates(["cid"]).select("cid", "set"), "sets")

    # One confirmed pair per set first: it makes most groups one component.
    pairs = staged(_by_largest_bucket(buckets, percent), "pairs")
    labels = staged(merged(members.select("cid", F.col("cid").alias("label")), confirmed(pairs, sets, percent)), "labels")
    still = staged(_open(buckets, labels), "open")
    again = staged(_by_centre(still, percent), "pairs")
    again = _ends(confirmed(again, sets, percent), labels).select(F.col("lx").alias("x"), F.col("ly").alias("y"))
    labels = staged(merged(labels, again), "labels")
    still = staged(_open(buckets, labels), "open")
    if still.limit(1).count():
        more = staged(_block_links(still, halves, sets, percent).distinct(), "links")
        labels = staged(merged(labels, more), "joined")

    root = F.min(F.struct(F.col("rep").isNull().alias("_null"), "rep", "fp")).alias("root")
    roots = classes.select("cid", "rep", "fp").join(labels, "cid").groupBy("label").agg(root).select("label", "root.rep", F.col("root.fp").alias("root_fp"))
    linked = labels.join(roots, "label").select("cid", F.col("rep").alias("root"), "root_fp")
    ids = classes.select("cid", "fp", "rep").join(linked, "cid", "left")
    ids = ids.select("fp", F.coalesce("root", "rep").alias("component_id"), F.coalesce("root_fp", "fp").alias("root_fp"))
    out = rows.select("doc_id", "text_key", "n_shingles", "fp").join(ids, "fp", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.col("doc_id").isNull() & component.isNull()).alias("kept"),
        F.lower(F.hex("fp")).alias("set_key"),
        F.lower(F.hex(F.coalesce("root_fp", "fp"))).alias("root_key"),
        "text_key",
    )
