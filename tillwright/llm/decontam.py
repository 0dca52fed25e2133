"""Benchmark decontamination with suffix arrays over the training text.

The corpus is cut into shards (runs of whole documents, a few hundred
thousand words each). In every shard the suffixes of all documents are sorted
by their first ``WINDOW`` words with prefix doubling, and every suffix of a
test item is searched in that order by binary search. Equal ranges hold all
locations, ordered by the word before; those with the item's own word before
lie inside a longer match and are passed over as one range, so a repetitive
text is not paired with every window of a repetitive item. Each location left
begins a longest verbatim match (``matches``), whose end is found by binary
search on hashes of runs. A document word inside a match is hit.

The benchmark is the stated query set. Spark packs it into blocks of about
``BLOCK_BYTES`` of text, one file each, in the shared folder; tasks read them
there, so no text of it passes the driver or the plan, and documents take one
pass, never shuffled or joined. A task keeps the first ``HELD_BLOCKS`` blocks
in memory and reads the others again for each of its shards, one at a time.
The files are opened with pyarrow, which knows local paths, ``hdfs``, ``s3``
(``s3a`` too), ``gs`` and ``abfs``.

Words are compared by 64-bit hashes. Defined results: null and texts without
words have no words and no hits; an item without words matches nothing; an
item of fewer than ``WINDOW`` words is one window; a null ``item_id`` is
reported as ``null``; items that repeat an id count once; an empty benchmark
leaves every document clean; rows repeating a ``doc_id`` are judged each by
its own text; other columns of the documents are kept, except those named
like the new ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum
from .common import appended, buffer_of, map_batches, passes, shared_table, staged_at, with_arrays

WINDOW = 10
#: Text of one block of the benchmark, in bytes.
BLOCK_BYTES = 1 << 20
#: Blocks that a task keeps in memory.
HELD_BLOCKS = 16

MATCHES = "array<struct<item_id: string, item_start: bigint, doc_start: bigint, n_words: bigint>>"


class Suffixes:
    """Suffix order of a shard's documents by their first words, by prefix doubling."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.n = len(hashes)
        self.left = np.repeat(first[1:], np.diff(first)) - np.arange(self.n)  # words up to the document's end
        self.vocabulary, inverse = np.unique(hashes, return_inverse=True)
        self.levels = [(1, None, inverse.astype(np.int64) + 1)]
        # The word before each position, 0 at a document's start.
        self.before = np.concatenate([[0], inverse[:-1] + 1]).astype(np.int64) if self.n else np.zeros(0, np.int64)
        self.before[first[:-1][first[:-1] < self.n]] = 0
        while 2 * self.levels[-1][0] <= WINDOW:
            width, _, rank = self.levels[-1]
            keys, inverse = np.unique(self._joined(rank, width, rank), return_inverse=True)
            self.levels.append((2 * width, keys, inverse + 1))

    def _joined(self, rank: np.ndarray, width: int, then: np.ndarray) -> np.ndarray:
        """Keys that order suffixes by ``rank``, then by ``then`` ``width`` words on (0 past the document's end)."""
        after = np.zeros(self.n, np.int64)
        inside = np.flatnonzero(self.left > width)
        after[inside] = then[inside + width]
        return rank * (self.n + 1) + after

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words from 1 on, 0 for words that the shard does not have."""
        if not self.n:
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def find(self, windows: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``windows``, position) of every occurrence of the rows, runs of as many word hashes each,
        that begins a match: the word before it is not ``before`` (0: no word the shard has)."""
        length = windows.shape[1]
        none = np.zeros(0, np.int64)
        if not self.n or not len(windows):
            return none, none
        at = np.searchsorted(self.vocabulary, windows)
        at[at == len(self.vocabulary)] = 0
        rows = np.flatnonzero((self.vocabulary[at] == windows).all(axis=1))
        # Ranks of the windows' parts, level by level, dropping windows that do not occur.
        parts = {1: at[rows] + 1}
        for width, keys, _ in self.levels[1:]:
            if width > length:
                break
            half = parts[width // 2]
            wanted = half[:, : length - width + 1] * (self.n + 1) + half[:, width // 2 : width // 2 + length - width + 1]
            found = np.searchsorted(keys, wanted)
            found[found == len(keys)] = 0
            there = (keys[found] == wanted).all(axis=1)
            rows, parts = rows[there], {w: p[there] for w, p in parts.items()}
            parts[width] = found[there] + 1
        if not len(rows):
            return none, none
        sizes = [w for w, _, _ in reversed(self.levels) if length & w]
        keys, wanted, done = self._order(sizes), parts[sizes[0]][:, 0], sizes[0]
        for size, (step_keys, order) in zip(sizes[1:], keys[1:], strict=True):
            wanted = wanted * (self.n + 1) + parts[size][:, done]
            if size is not sizes[-1]:
                found = np.searchsorted(step_keys, wanted)
                found[found == len(step_keys)] = 0
                there = step_keys[found] == wanted
                rows, parts = rows[there], {w: p[there] for w, p in parts.items()}
                wanted = found[there] + 1
            done += size
        step_keys, order = keys[-1]
        lo, hi = np.searchsorted(step_keys, wanted, side="left"), np.searchsorted(step_keys, wanted, side="right")
        # Occurrences lie in the order of the word before them: those with the item's own
        # word before are no beginnings of a match and are left out as one range.
        words = len(self.vocabulary) + 1
        group = np.searchsorted(step_keys, step_keys, side="left") * words + self.before[order]
        own = lo * words + before[rows]
        skip_lo, skip_hi = np.searchsorted(group, own, side="left"), np.searchsorted(group, own, side="right")
        whole = before[rows] <= 0
        skip_lo, skip_hi = (np.where(whole, hi, np.clip(x, lo, hi)) for x in (skip_lo, skip_hi))
        out_rows, out_at = [], []
        for start, stop in ((lo, skip_lo), (skip_hi, hi)):
            counts = stop - start
            within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            out_rows.append(np.repeat(rows, counts))
            out_at.append(order[np.repeat(start, counts) + within])
        return np.concatenate(out_rows), np.concatenate(out_at)

    def _order(self, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per part of the length: sorted keys; the last with the suffix array."""
        ranks = {width: rank for width, _, rank in self.levels}
        rank, done, out = ranks[sizes[0]], sizes[0], [(np.zeros(0), None)]
        for k, size in enumerate(sizes[1:], 1):
            joined = self._joined(rank, done, ranks[size])
            if k < len(sizes) - 1:
                keys, inverse = np.unique(joined, return_inverse=True)
                out.append((keys, None))
                rank = inverse + 1
            else:
                rank = joined
            done += size
        order = np.lexsort((self.before, rank))
        if len(sizes) > 1:
            out.append((rank[order], order))
        else:
            out = [(rank[order], order)]
        return out


class Items:
    """The words of a block of test items, and by window length (windows, item, first word) of all their windows."""

    def __init__(self, texts: list[str | None]):
        data, offsets = buffer_of(pa.array(texts, pa.string()))
        self.hashes, _, _, self.first = textnum.words(data, offsets, textnum.ALNUM)
        n_words = np.diff(self.first)
        self.windows = []
        for length in np.unique(np.minimum(n_words, WINDOW)):
            if length:
                items = np.flatnonzero(np.minimum(n_words, WINDOW) == length)
                counts = n_words[items] - length + 1
                item = np.repeat(items, counts)
                at = np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)
                self.windows.append((int(length), item, at))

    def rows(self, length: int, item: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.hashes[(self.first[item] + at)[:, None] + np.arange(length)]


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _sums(hashes: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial of the hashes."""
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[: len(hashes)], dtype=np.uint64)])


def extended(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Most words, from ``least`` (known to be equal) to ``most``, that the words x from i and y from j have in common: binary search on hashes of runs."""
    n = max(len(x), len(y), 1)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.append(np.uint64(1), np.full(n, _BASE)), dtype=np.uint64)
        sx, sy = _sums(x, powers), _sums(y, powers)
        low, high = least.copy(), most.copy()
        while True:
            going = np.flatnonzero(low < high)
            if not len(going):
                return low
            a, b = i[going], j[going]
            middle = (low[going] + high[going] + 1) // 2
            same = (sx[a + middle] - sx[a]) * powers[b] == (sy[b + middle] - sy[b]) * powers[a]
            low[going] = np.where(same, middle, low[going])
            high[going] = np.where(same, high[going], middle - 1)


def _covered(doc: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans joined where they overlap or touch, by document: (doc, start, end)."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    base = doc * (size + 2)
    reach = np.maximum.accumulate(end + base) if len(doc) else end
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + base[1:] > reach[:-1]
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(doc)) - 1
    return doc[firsts], start[firsts], (reach - base)[lasts] if len(doc) else end


class Blocks:
    """Blocks of the benchmark, each given by ``load(number)`` as (item ids, texts); the first few stay in memory."""

    def __init__(self, count: int, load: Callable[[int], tuple[pa.Array, list[str | None]]], held: int = HELD_BLOCKS):
        self.count, self.load, self.most = count, load, held
        self.held: dict[int, tuple[pa.Array, Items]] = {}

    def __iter__(self) -> Iterator[tuple[pa.Array, Items]]:
        for k in range(self.count):
            block = self.held.get(k)
            if block is None:
                names, texts = self.load(k)
                block = names, Items(texts)
                if k < self.most:
                    self.held[k] = block
            yield block


def _matches(shard: Suffixes, block: Items, hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(item, its word, word of the shard, words) of every longest match with a block's items."""
    found = [(np.zeros(0, np.int64),) * 4]
    for length, items, at in block.windows:
        before = np.where(at > 0, shard.known(block.hashes[np.maximum(block.first[items] + at - 1, 0)]), 0)
        which, where = shard.find(block.rows(length, items, at), before)
        item, start = items[which], at[which]
        most = np.minimum(np.diff(block.first)[item] - start, ends[where] - where) if len(where) else where
        size = extended(block.hashes, block.first[item] + start, hashes, where, np.full(len(where), length), most)
        found.append((item, start, where, size))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _search(benchmark: Blocks):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, "text"):
            data, offsets = buffer_of(batch.column("text"))
            hashes, _, _, first = textnum.words(data, offsets, textnum.ALNUM)
            shard = Suffixes(hashes, first)
            ends = np.repeat(first[1:], np.diff(first))
            names, found, items = [pa.array([], pa.string())], [(np.zeros(0, np.int64),) * 4], 0
            for ids, block in benchmark:
                item, *rest = _matches(shard, block, hashes, ends)
                # Only names of items that match are kept, numbered on from block to block.
                matching, number = np.unique(item, return_inverse=True)
                names.append(ids.take(pa.array(matching)))
                found.append((number + items, *rest))
                items += len(matching)
            item, at, start, size = (np.concatenate(x) for x in zip(*found, strict=True))
            doc = np.searchsorted(first, start, side="right") - 1
            order = np.lexsort((at, item, start, doc))
            item, at, start, size, doc = item[order], at[order], start[order], size[order], doc[order]
            start = start - first[doc]
            columns = [pa.concat_arrays(names).take(pa.array(item)), pa.array(at), pa.array(start), pa.array(size)]
            matches = pa.StructArray.from_arrays(columns, ["item_id", "item_start", "doc_start", "n_words"])
            lists = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))]).astype(np.int32)
            hit_doc, hit_start, hit_end = _covered(doc, start, start + size, len(hashes))
            n_hit = np.zeros(batch.num_rows, np.int64)
            np.add.at(n_hit, hit_doc, hit_end - hit_start)
            yield with_arrays(
                batch,
                _n=pa.array(np.diff(first), pa.int64()),
                _hit=pa.array(n_hit),
                _matches=pa.ListArray.from_arrays(pa.array(lists), matches),
            )

    return search


def _packed(most: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(item)
                texts.append(text)
                size += len(text or "")
                if size >= most:
                    yield pa.RecordBatch.from_pydict({"ids": [ids], "texts": [texts]}, PACKED)
                    ids, texts, size = [], [], 0
        if ids:
            yield pa.RecordBatch.from_pydict({"ids": [ids], "texts": [texts]}, PACKED)

    return pack


PACKED = pa.schema([("ids", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def packed(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Blocks:
    """The benchmark as blocks of about ``most`` bytes of text, one file each in the shared folder."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").hint("rebalance")
    blocks = map_batches(rows, _packed(most), "ids array<string>, texts array<string>")
    table, _ = staged_at(blocks, "benchmark", maxRecordsPerFile=1)
    paths = sorted(table.inputFiles())

    def load(k: int) -> tuple[pa.Array, list[str | None]]:
        block = shared_table(paths[k])
        return block["ids"].combine_chunks().flatten().cast(pa.string()), block["texts"].combine_chunks().flatten().to_pylist()

    return Blocks(len(paths), load)


def search(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (sorted), items_sha256, contaminated and matches."""
    # Input columns go by names that no work column has, and get their own back at the end.
    new = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "matches"]
    carried = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c not in new and c != "text"}
    df = docs.select("text", *[F.col(f"`{c}`").alias(name) for c, name in carried.items()])
    df = appended(df, _search(packed(benchmark, block_bytes)), f"_n bigint, _hit bigint, _matches {MATCHES}")
    df = df.withColumns(
        {
            "n_words": F.col("_n"),
            "n_hit": F.col("_hit"),
            "items": F.array_sort(F.array_distinct(F.col("_matches")["item_id"])),
            "matches": F.col("_matches"),
        }
    )
    df = df.withColumns(
        {"n_items": F.size("items").cast("bigint"), "items_sha256": F.sha2(F.array_join("items", ","), 256), "contaminated": F.col("n_hit") > 0}
    )
    own = [F.col("text") if c == "text" else F.col(carried[c]).alias(c) for c in docs.columns if c not in new]
    return df.select(*own, *new)
