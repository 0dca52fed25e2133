"""N-gram Jaccard join by signature trees.

A text's set holds the hashes of its distinct 3-word shingles; equal sets are
one class. Sets link from 90 % similarity on.

Which sets can meet. Sizes fall into classes whose next bound is 1 / 0.9 of the
last, so linked sets lie in one class or in neighbouring ones. Two linked sets
differ in at most a ninth of the smaller one's size; cut the hash space into one
part more than the largest such number of a class, and they agree on one part
completely. The content of a part is a key. Every pair that links shares a key
(no chance in it), and a key holds about nine shingles, so a line or passage
that many texts share makes no common key by itself. Sets connected by keys are a
cluster.

How they are compared. The sets of a cluster and size class are laid out by
their smallest hashes, which puts near copies side by side, and cut into blocks of
``BLOCK_SETS`` sets or ``BLOCK_SHINGLES`` shingles. A task gets two blocks and builds
a signature tree over each: a leaf is a set, a node holds the OR of the token
bitmaps below it and the range of their sizes. The trees are traversed together.
A node pair is dropped if the sizes do not allow the similarity, if its sets
are in one component already, or if the most tokens any two of its sets
can share, common bits plus the tokens that fell on a bit taken, are
too few. What is left of the leaves is decided on the full sets; a pair whose sets
became one component meanwhile is skipped, so a group of n near copies takes about n decisions.

Rounds. First each block meets itself and the next one, which makes a group of near
copies one component at any size. Then only keys whose sets lie in several
components are open. Of their sets, one with a link to another component has
90 % of its shingles in other components; the others are done. The rest are laid out
anew and all pairs of blocks are traversed. No pair that can link is left out, no
pairs of a group are listed.

Defined results: null is an empty text; texts without words have
``n_shingles`` 0 and stay alone; a null ``doc_id`` takes part, and
``component_id`` is the smallest id that is not null (null without any); rows that
repeat a ``doc_id`` are judged each by its own text; an empty table gives no rows.
Only the columns doc_id and text are read.
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
from .minhash import fingerprint, shingle_sets

SHINGLE = 3
PERCENT = 90
#: Limits of a block; a single larger set is a block of its own.
BLOCK_SETS = 256
BLOCK_SHINGLES = 1 << 20
#: Children of a node.
FANOUT = 8
#: Bits of a leaf's bitmap for each shingle of the largest set (a power of two is taken).
BITS_PER_SHINGLE = 8
#: Words of bitmaps that one step of the traversal compares (bounds its memory).
STEP_WORDS = 1 << 20


def differences(n: int, percent: int = PERCENT) -> int:
    """Most shingles in which a linked pair can differ if its smaller set has n."""
    return n * (100 - percent) // percent


def size_bounds(n: int, percent: int = PERCENT) -> list[int]:
    """First sizes of the classes up to the class after that of n: a set linked with one of class c lies in c or, if larger, c + 1."""
    bounds = [1]
    while bounds[-1] <= n:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return [*bounds, bounds[-1] * 100 // percent + 1]


class _Classes:
    """Size classes, grown as larger sets come."""

    def __init__(self, percent: int) -> None:
        self.percent, self.bounds = percent, size_bounds(1000, percent)

    def of(self, n: int) -> int:
        if n >= self.bounds[-2]:
            self.bounds = size_bounds(n, self.percent)
        return int(np.searchsorted(self.bounds, n, side="right")) - 1

    def parts(self, c: int) -> int:
        return differences(self.bounds[c + 1] - 1, self.percent) + 1


def part_keys(hashes: np.ndarray, classes: _Classes) -> list[int]:
    """Keys of a sorted set: the contents of its parts, for its size class and the one below."""
    if not len(hashes):
        return []
    own, out = classes.of(len(hashes)), []
    sums = np.zeros(len(hashes) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(textnum.mixed(hashes), dtype=np.uint64, out=sums[1:])
        for c in (own - 1, own):
            if c < 0 or (parts := classes.parts(c)) < 2:  # sets that cannot differ are one class already
                continue
            cuts = np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts)
            ends = sums[np.concatenate([[0], np.searchsorted(hashes, cuts), [len(hashes)]])]
            content = ends[1:] - ends[:-1]
            salt = np.arange(parts, dtype=np.uint64) + np.uint64(c << 40)
            out.append(textnum.mixed(textnum.mixed(salt + np.uint64(1)) ^ content))
    return np.concatenate(out).view(np.int64) if out else []


def _signatures(percent: int):
    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _Classes(percent)
        for batch in passes(batches, "text"):
            sizes, prints, keys, level = [], [], [], []
            for hashes in shingle_sets(*buffer_of(batch.column("text")), SHINGLE):
                hashes = np.sort(hashes)
                sizes.append(len(hashes))
                prints.append(fingerprint(hashes))
                level.append(classes.of(len(hashes)) if len(hashes) else None)
                keys.append(part_keys(hashes, classes))
            columns = [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(level, pa.int32()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_shingles", "fp", "level", "keys"])

    return signatures


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches, "text"):
        prints, sets = [], []
        for hashes in shingle_sets(*buffer_of(batch.column("text")), SHINGLE):
            prints.append(fingerprint(hashes))
            sets.append(np.sort(hashes).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["fp", "set"])


class Tree:
    """Signature tree over sets in a given order. Level 0 holds the leaves; each level above has a node for FANOUT below.

    Of each node: OR of the bitmaps, least and most tokens, and the most
    tokens of one set that fell on a bit already taken (``spare``).
    """

    def __init__(self, sets: list[np.ndarray], bits: int) -> None:
        n = np.array([len(s) for s in sets], np.int64)
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for i, s in enumerate(sets):
            at = np.unique(s.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64)
            word, first = np.unique(at >> 6, return_index=True)
            maps[i, word] = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
        spare = n - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, n, n, spare)]
        while len(self.levels[-1][1]) > 1:
            maps, least, most, spare = self.levels[-1]
            cut = np.arange(0, len(least), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut), np.maximum.reduceat(spare, cut)))


def _possible(a, b, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets below the nodes i of level a and j of level b may be similar enough."""
    (maps_a, least_a, most_a, spare_a), (maps_b, least_b, most_b, spare_b) = a, b
    out = (100 * most_a[i] >= percent * least_b[j]) & (100 * most_b[j] >= percent * least_a[i])
    step = max(1, STEP_WORDS // maps_a.shape[1])
    for k in range(0, len(i), step):
        x, y = i[k : k + step], j[k : k + step]
        shared = np.bitwise_count(maps_a[x] & maps_b[y]).sum(axis=1, dtype=np.int64) + np.minimum(spare_a[x], spare_b[y])
        shared = np.minimum(shared, np.minimum(most_a[x], most_b[y]))
        # 100 * common >= percent * (n_x + n_y - common) for the smallest sizes that are possible
        out[k : k + step] &= (100 + percent) * shared >= percent * (least_a[x] + least_b[y])
    return out


def candidates(a: Tree, b: Tree, label_a: np.ndarray, label_b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs that a dual traversal of both trees does not rule out."""

    def uniform(tree: Tree, label: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out = [(label, label)]
        for _ in tree.levels[1:]:
            lo, hi = out[-1]
            cut = np.arange(0, len(lo), FANOUT)
            out.append((np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut)))
        return out

    same_a, same_b = uniform(a, label_a), uniform(b, label_b)
    da, db = len(a.levels) - 1, len(b.levels) - 1
    i = j = np.zeros(1, np.int64)
    while True:
        (lo_a, hi_a), (lo_b, hi_b) = same_a[da], same_b[db]
        one = (lo_a[i] == hi_a[i]) & (lo_b[j] == hi_b[j]) & (lo_a[i] == lo_b[j])
        if a is b and da == db:
            one |= i > j  # the other order comes as well
        i, j = i[~one], j[~one]
        keep = _possible(a.levels[da], b.levels[db], i, j, percent)
        i, j = i[keep], j[keep]
        if (da, db) == (0, 0) or not len(i):
            return i, j
        down_a, down_b = da >= db and da > 0, db >= da and db > 0
        fan_a = np.arange(FANOUT if down_a else 1)
        fan_b = np.arange(FANOUT if down_b else 1)
        shape = (len(i), len(fan_a), len(fan_b))
        x = np.broadcast_to((i[:, None] * len(fan_a) + fan_a)[:, :, None], shape).ravel()
        y = np.broadcast_to((j[:, None] * len(fan_b) + fan_b)[:, None, :], shape).ravel()
        da, db = da - down_a, db - down_b
        real = (x < len(a.levels[da][1])) & (y < len(b.levels[db][1]))
        i, j = x[real], y[real]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    common = int((a[at] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def spanning(sets: list[np.ndarray], label: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between labels, from the candidate pairs i, j of sets: each step decides at most one pair of each i, and pairs within a component are skipped."""
    label, links = label.copy(), []
    while len(i):
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        _, first = np.unique(i, return_index=True)
        for k in first:
            x, y = label[i[k]], label[j[k]]
            if x != y and similar(sets[i[k]], sets[j[k]], percent):
                links.append((int(x), int(y)))
                label[label == max(x, y)] = min(x, y)
        rest = np.ones(len(i), bool)
        rest[first] = False
        i, j = i[rest], j[rest]
    return links


def _traversed(percent: int, within: bool):
    def traverse(table: pa.Table) -> pa.Table:
        """Links (labels x, y) by dual traversal: of one block's tree with itself, or of the trees of two blocks; ``within``: also of the first with itself."""
        table = table.combine_chunks()
        sides, sets, label = [], [], []
        for side in sorted(set(table.column("side").to_pylist())):
            rows = np.flatnonzero(np.asarray(table.column("side")) == side)
            mine = [np.asarray(x.values).view(np.uint64) for x in table.column("set").chunk(0).take(pa.array(rows))]
            names = np.asarray(table.column("label"))[rows]
            order = sorted(range(len(mine)), key=lambda k: mine[k][:4].tolist())
            sides.append(len(mine))
            sets += [mine[k] for k in order]
            label.append(names[order])
        most = max(len(s) for s in sets) * BITS_PER_SHINGLE
        bits = 1 << max(6, int(most - 1).bit_length())
        first = Tree(sets[: sides[0]], bits)
        second = first if len(sides) == 1 else Tree(sets[sides[0] :], bits)
        i, j = candidates(first, second, label[0], label[-1], percent)
        if second is not first:
            j = j + sides[0]
            if within:
                i, j = (np.concatenate(x) for x in zip(candidates(first, first, label[0], label[0], percent), (i, j), strict=True))
        links = spanning(sets, np.concatenate(label), i, j, percent)
        return pa.table({"x": pa.array([x for x, _ in links], pa.int64()), "y": pa.array([y for _, y in links], pa.int64())})

    return traverse


def _laid_out(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """(cid, cluster, level, block): blocks of each cluster and size class, near copies side by side.

    The sizes of a level say how many sets a block of it may hold.
    """
    placed = ranked(sets.select("cid", "level", "least").join(clusters, "cid"), ["least", "cid"], ["cluster", "level"], "places", few_groups=False)
    holds = [max(1, min(BLOCK_SETS, BLOCK_SHINGLES // n)) for n in size_bounds(BLOCK_SHINGLES, percent)[1:]]
    hold = F.coalesce(F.get(F.array(*[F.lit(h) for h in holds]), F.col("level")), F.lit(1))
    return placed.select("cid", "cluster", "level", F.call_function("div", F.col("rank"), hold).alias("block"))


def _links(meets: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, within: bool) -> DataFrame:
    """Distinct links (labels x, y) of ``meets`` (cid, task, side)."""
    whole = meets.join(sets.select("cid", "set"), "cid").join(labels, "cid").select("task", "side", "set", "label")
    return whole.groupBy("task").applyInArrow(_traversed(percent, within), "x bigint, y bigint").distinct()


def _neighbours(blocks: DataFrame) -> DataFrame:
    """(cid, task, side): each block (side 0) with the next one of its cluster (side 1), levels in order."""
    numbers = blocks.select("cluster", "level", "block").distinct()
    numbers = ranked(numbers, ["level", "block"], ["cluster"], "blocks", few_groups=False).withColumnRenamed("rank", "at")
    mine = blocks.join(numbers, ["cluster", "level", "block"])
    tasks = F.when(F.col("at") == 0, F.array("at")).otherwise(F.array("at", F.col("at") - 1))
    spread = mine.select("cid", "cluster", "at", F.explode(tasks).alias("k"))
    return spread.select("cid", F.struct("cluster", "k").alias("task"), (F.col("at") != F.col("k")).cast("int").alias("side"))


def _all_pairs(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """(cid, task, side): every pair of blocks of one cluster whose levels are equal or next to each other and which are not all of one component."""
    roots = blocks.join(labels, "cid").groupBy("cluster", "level", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    other = roots.select("cluster", F.struct("level", "block", "lo", "hi").alias("b"))
    near = (F.col("b.level") == F.col("level")) & (F.col("b.block") >= F.col("block")) | (F.col("b.level") == F.col("level") + 1)
    apart = F.least("lo", "b.lo") != F.greatest("hi", "b.hi")
    pairs = roots.join(other, "cluster").filter(near & apart)
    sides = F.array(F.struct("level", "block", F.lit(0).alias("side")), F.struct("b.level", "b.block", F.lit(1).alias("side")))
    same = (F.col("level") == F.col("b.level")) & (F.col("block") == F.col("b.block"))
    task = F.struct("cluster", "level", "block", F.col("b.level").alias("level_b"), F.col("b.block").alias("block_b"))
    spread = pairs.select("cluster", task.alias("task"), F.explode(F.when(same, F.slice(sides, 1, 1)).otherwise(sides)).alias("s"))
    spread = spread.select("cluster", "task", "s.level", "s.block", "s.side")
    return blocks.join(spread, ["cluster", "level", "block"]).select("cid", "task", "side")


def _open_sets(keys: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(open keys (key, cid), labels of their sets): sets that share a key with another component and have PERCENT of their shingles in others."""
    mine = keys.join(labels, "cid")
    spread = mine.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("key")
    still = staged(mine.join(spread, "key").select("key", "cid", "label"), "open-keys")
    who = still.select("cid", "label").distinct()
    shingles = sets.join(who, "cid").select("cid", "label", F.explode("set").alias("s"))
    abroad = shingles.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("s")
    common = shingles.join(abroad, "s", "left_semi").groupBy("cid").agg(F.count("*").alias("n"))
    kept = sets.join(common, "cid").filter(100 * F.col("n") >= percent * F.size("set")).select("cid")
    kept = staged(kept, "open-sets")
    return still.join(kept, "cid").select("key", "cid"), who.join(kept, "cid")


def _stars(keys: DataFrame) -> DataFrame:
    """Edges (x, y) that connect the sets of each key."""
    centre = keys.groupBy("key").agg(F.min("cid").alias("x"))
    return keys.join(centre, "key").select("x", F.col("cid").alias("y")).filter("x != y").distinct()


def jaccard_join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id and ``set_key`` (the class of equal sets, hex)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    rows = staged(map_batches(docs, _signatures(percent), "doc_id bigint, n_shingles bigint, fp binary, level int, keys array<bigint>"), "signatures")
    classes = rows.filter("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("level").alias("level"), F.first("keys").alias("keys"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    every = classes.select("cid", F.explode("keys").alias("key"))
    shared = every.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    keys, keys_at = staged_at(every.join(shared, "key"), "keys")
    members = staged(keys.select("cid").distinct().join(classes.select("cid", "fp", "rep", "level"), "cid"), "members")
    texts = docs.join(members.select("rep").distinct(), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    # Classes are found by their sets, so rows that share an id, or lack one, do not mix.
    sets = map_batches(texts.select("text"), _sets, "fp binary, set array<bigint>").join(members.select("fp", "cid", "level"), "fp")
    sets, sets_at = staged_at(sets.dropDuplicates(["cid"]).select("cid", "level", F.col("set")[0].alias("least"), "set"), "sets")

    clusters = components(_stars(keys)).select(F.col("node").alias("cid"), F.col("label").alias("cluster"))
    blocks = staged(_laid_out(sets, clusters, percent), "laid-out")
    own = members.select("cid", F.col("cid").alias("label"))
    links = staged(_links(_neighbours(blocks), sets, own, percent, True), "links")
    labels = staged(merged(own, links), "labels")
    open_keys, who = _open_sets(keys, sets, labels, percent)
    if who.limit(1).count():
        open_keys = staged(open_keys, "open")
        clusters = components(_stars(open_keys)).select(F.col("node").alias("cid"), F.col("label").alias("cluster"))
        blocks = staged(_laid_out(sets.join(who.select("cid"), "cid"), clusters, percent), "laid-out")
        more = staged(_links(_all_pairs(blocks, who), sets, who, percent, False), "links")
        labels = staged(merged(labels, more), "labels")

    roots = classes.select("cid", "rep").join(labels, "cid").groupBy("label").agg(F.min("rep").alias("root"))
    ids = classes.select("cid", "fp", "rep").join(labels.join(roots, "label").select("cid", "root"), "cid", "left")
    ids = staged(ids.select("fp", F.coalesce("root", "rep").alias("component_id")), "ids")
    dropped(spark, keys_at)
    dropped(spark, sets_at)
    out = rows.select("doc_id", "n_shingles", "fp").join(ids, "fp", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.lower(F.hex("fp")).alias("set_key"))
