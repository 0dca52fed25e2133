"""Source divergence audit: how far the term shares of sources lie apart, by a frequent-pattern tree.

Each kept term of a language is one row: its nonzero counts by source, in
source order. For two sources s and t, the sum over all V kept terms is

    V * f0(s, t)                                   every term as if neither had it
    + per distinct count of one source             as if the other had 0
    + per node and ancestor of the tree            what both having it changes

The tree is the prefix tree of the term rows: a node is (source, count) below
its path, and its multiplicity is the number of terms through it. Rows with
equal counts are first counted as one path with a multiplicity (combined
map-side, so a path that a third of all terms share is one addend per task).
Paths are range-sorted, so paths that share a prefix lie next to each other;
each batch of a task's run of paths is walked as a tree, which adds the correction of each node
and each of its ancestors once, times the node's multiplicity. A node that a
batch cuts counts as two, with the multiplicities of its parts, so sums
stay exact. Only one sum for each pair of sources leaves a batch.

Terms are counted inside tasks by exact dictionaries of Arrow, combined every
``COMBINE`` rows, so what is shuffled grows with distinct terms of a task, not
with words. All arithmetic is on integers: shares p in decimals where the
product with 10^9 may pass 64 bits, f within 64 bits (p is at most 10^9 + 1).

Defined results: null text, lang and source are ''; an empty table gives no rows; a
group without kept terms has value 0 where V is 0 and else shares of zero
counts; documents are rows, so rows repeating a ``doc_id`` count each; ties are
ordered by item; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buffer_of, map_batches, passes, staged

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Distinct (lang, source, term) rows that a task holds before it passes them on.
COMBINE = 1 << 19

#: Terms `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`: letters and all beyond ASCII.
_TERM = np.array([b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts, lower-cased, and the text of each."""
    inside = _TERM[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[offsets[offsets < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    letters = _LOWER[data[inside]]
    at = np.cumsum(inside) - 1
    ends = np.append(at[starts], len(letters)).astype(np.int32)
    terms = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    return terms, np.searchsorted(offsets, starts, side="right") - 1


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of one batch."""
    groups = pa.table({c: batch.column(c) for c in ("lang", "source")}).group_by(["lang", "source"]).aggregate([])
    keys = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"])
    known = {(g["lang"], g["source"]): i for i, g in enumerate(groups.to_pylist())}
    group = np.array([known[k["lang"], k["source"]] for k in keys.to_pylist()], np.int64)
    terms, row = terms_of(*buffer_of(batch.column("text")))
    encoded = terms.dictionary_encode()
    index, size = encoded.indices.to_numpy().astype(np.int64), max(1, len(encoded.dictionary))
    # Once per text and term, then once per group and term.
    pairs, n = np.unique(row * size + index, return_counts=True)
    cells, inverse = np.unique(group[pairs // size] * size + pairs % size, return_inverse=True)
    at, docs = np.bincount(inverse, weights=n, minlength=len(cells)), np.bincount(inverse, minlength=len(cells))
    of = pa.array(cells // size)
    columns = [groups.column("lang").take(of), groups.column("source").take(of), encoded.dictionary.take(pa.array(cells % size)), pa.array(at.astype(np.int64)), pa.array(docs.astype(np.int64))]
    return pa.table(columns, names=_COUNTS.names)


def _combined(parts: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    whole = pa.concat_tables(parts).group_by(keys).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.select([*keys, "n_sum", "docs_sum"]).rename_columns(_COUNTS.names)


def _rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """(lang, term, sources, n, docs): the sources of each term as arrays."""
    keys = ["lang", "term"]
    out = table.group_by(keys, use_threads=False).aggregate([("source", "list"), ("n", "list"), ("docs", "list")])
    out = out.select([*keys, "source_list", "n_list", "docs_list"]).rename_columns(["lang", "term", "sources", "n", "docs"])
    yield from out.combine_chunks().to_batches(max_chunksize=1 << 15)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0
    for batch in passes(batches, "text"):
        counted = _counted(batch)
        parts.append(counted)
        size += len(counted)
        if size > COMBINE:
            whole = _combined(parts)
            parts, size = [whole], len(whole)
            if size > COMBINE // 2:
                yield from _rows(whole)
                parts, size = [], 0
    if parts:
        yield from _rows(_combined(parts))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, total, source, n): kept terms by source; total is over all sources. Nulls are '' already."""
    rows = map_batches(docs.select("lang", "source", "text"), _count_terms, "lang string, term binary, sources array<string>, n array<bigint>, docs array<bigint>", rows=1024)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "lang", "term")  # the one shuffle: both groupings below keep this partitioning
    items = rows.select("lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("n").alias("n"), F.col("docs").alias("docs"))))
    by_source = items.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("items"))
    return kept.filter(F.col("docs") >= MIN_DOCS).select("lang", F.col("term").cast("string").alias("term"), "total", F.inline("items"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + kept)), exact for any counts of 64 bits."""
    product = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", product, (total + kept).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) within 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, s, t, value): corrections of all node-ancestor pairs of sorted paths (lang, path, times).

    A path is a list of (source, n, p, p0). The tree of a batch is read off the
    prefix each row shares with the row before: a row opens its nodes below that
    prefix, and a node's multiplicity adds up until a row shares less.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, items = batch.column("path"), batch.column("path").values
        starts = np.asarray(paths.offsets).astype(np.int64)
        length, starts = np.diff(starts), starts[:-1]
        names = items.field("source").dictionary_encode()
        source = names.indices.to_numpy().astype(np.int64)
        n, p, p0 = (items.field(c).to_numpy() for c in ("n", "p", "p0"))
        langs = batch.column("lang").dictionary_encode()
        lang = langs.indices.to_numpy().astype(np.int64)
        times = batch.column("times").to_numpy()

        size = len(names.dictionary)
        alive = np.append(False, lang[1:] == lang[:-1])
        keys, values = [], []
        for d in range(int(length.max())):
            rows = np.flatnonzero(length > d)
            at, above = starts[rows] + d, starts[np.maximum(rows - 1, 0)] + d
            same = alive[rows] & (length[np.maximum(rows - 1, 0)] > d)
            above = np.where(same, above, at)
            same &= (source[at] == source[above]) & (n[at] == n[above])
            alive = np.zeros(len(length), bool)
            alive[rows] = same
            first = np.flatnonzero(~same)  # the rows that open a node at this depth
            through = np.add.reduceat(times[rows], first) if len(first) else times[:0]
            node = starts[rows[first]]
            s, ps, zs = source[node + d], p[node + d], p0[node + d]
            for e in range(d):
                t, pt, zt = source[node + e], p[node + e], p0[node + e]
                both, one, other, none = (ps - pt) ** 2, (ps - zt) ** 2, (zs - pt) ** 2, (zs - zt) ** 2
                pair = lang[rows[first]] * size
                keys += [(pair + s) * size + t, (pair + t) * size + s]
                values += [through * (both // pt - one // zt - other // pt + none // zt), through * (both // ps - one // ps - other // zs + none // zs)]
        if not keys:
            continue
        pairs, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, inverse, np.concatenate(values))
        of = [langs.dictionary.take(pa.array(pairs // size // size)), names.dictionary.take(pa.array(pairs // size % size)), names.dictionary.take(pa.array(pairs % size))]
        yield pa.RecordBatch.from_arrays([*of, pa.array(sums)], ["lang", "s", "t", "value"])


def pair_corrections(priced: DataFrame) -> DataFrame:
    """(lang, s, t, value) of the tree over the term rows of ``priced`` (lang, term, source, n, p, p0)."""
    terms = priced.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "n", "p", "p0"))).alias("path"))
    paths = terms.groupBy("lang", "path").agg(F.count("*").alias("times"))
    parts = int(priced.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = staged(paths, "paths").repartitionByRange(parts, "lang", "path").sortWithinPartitions("lang", "path")
    return map_batches(laid, _walk, "lang string, s string, t string, value bigint", rows=1 << 14)


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank over ``docs`` (text, lang, source)."""
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = staged(term_counts(docs), "term-counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang", "term").agg(F.first("total").alias("n")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "kept", "lang_total")])
    zero = F.when(F.col("kept") > 0, share(F.lit(0).cast("bigint"), F.col("total"), F.col("kept")))
    groups = staged(groups.withColumn("p0", zero), "groups")
    priced = counts.withColumnRenamed("total", "term_total").join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))

    wide = "decimal(38,0)"
    # The pairs of sources of a language are what is asked for: one output row each.
    base = groups.select("lang", F.col("source").alias("s"), "p0", "kept").join(groups.select("lang", F.col("source").alias("t"), F.col("p0").alias("q0")), "lang").filter("s != t")
    base = base.select("lang", "s", "t", F.coalesce(F.col("kept").cast(wide) * gap(F.col("p0"), F.col("q0")), F.lit(0)).cast(wide).alias("value"))
    single = priced.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times"))
    other = groups.select("lang", F.col("source").alias("t"), F.col("p0").alias("q0"))
    against = single.join(other, "lang").filter("source != t")
    p, p0, q0, times = F.col("p"), F.col("p0"), F.col("q0"), F.col("times").cast("decimal(19,0)")
    forth = against.select("lang", F.col("source").alias("s"), "t", ((gap(p, q0) - gap(p0, q0)).cast("decimal(19,0)") * times).cast(wide).alias("value"))
    back = against.select("lang", F.col("t").alias("s"), F.col("source").alias("t"), ((gap(q0, p) - gap(q0, p0)).cast("decimal(19,0)") * times).cast(wide).alias("value"))
    both = pair_corrections(priced).select("lang", "s", "t", F.col("value").cast(wide).alias("value"))
    sums = base.unionByName(forth).unionByName(back).unionByName(both).groupBy("lang", "s", "t").agg(F.sum("value").cast("bigint").alias("value"))
    order = [F.col("value").desc(), F.col("item").asc()]
    pairs = sums.select("lang", F.col("s").alias("source"), F.lit("pair").alias("part"), F.col("t").alias("item"), "value")

    q = share(F.col("term_total"), F.col("lang_total"), F.col("kept"))
    terms = priced.withColumn("q", q).filter("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).filter(F.col("rank") <= TOP_TERMS))
