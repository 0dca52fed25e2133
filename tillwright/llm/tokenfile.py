"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

Documents are range-partitioned by id and sorted, and each partition writes
its documents in blocks of about ``BLOCK_TOKENS`` ids. A block ranks its ids by
frequency and stores, apart from each other, the ranked dictionary, the
lengths of its documents, control bytes (four 2-bit byte counts each) and the
data bytes (1 to 4 for an id's rank, low byte first). Decoding looks the
control bytes up in a table of 256 rows, which gives all positions by one
prefix sum, and is vectorised. A block is a value of a binary column, so files
are written and committed by Spark on any file system, and a lost task writes
its blocks again.

Texts are encoded by the tokenizers library: a document is cut into the
library's pre-tokens, each distinct one is encoded by the library once, and
documents are gathered from them, which gives the library's own ids.

Defined results: null is an empty text, which holds the end id alone; control
strings of the tokenizer in a text become their ids; null ids come first, rows
with equal ids are ordered by the hash of their texts; an empty table writes
no block; only doc_id and text are read, other columns may have any name and
are not returned.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import map_batches, passes
from .pieces import Table, encode_texts

END_ID = 2
BLOCK_TOKENS = 1 << 19
#: Blocks in one Arrow batch when files are read.
BLOCK_ROWS = 8
#: Pre-tokens that the library encodes in one text.
JOINED = 64

FILES = "part int, before bigint, n_tokens bigint, block binary"
_MAGIC = 0x314B4F54
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack(ids: np.ndarray, counts: np.ndarray, doc_ids: list) -> bytes:
    """A block: the documents' ids end to end, their lengths and doc_ids."""
    seen = np.bincount(ids)
    values = np.flatnonzero(seen)
    values = values[np.argsort(-seen[values], kind="stable")]
    rank_of = np.zeros(len(seen), np.uint32)
    rank_of[values] = np.arange(len(values), dtype=np.uint32)
    ranks = rank_of[ids]
    n_bytes = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = n_bytes - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    raw = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4) < n_bytes[:, None]]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = np.array([_MAGIC, len(doc_ids), len(ids), len(values)], "<u8")
    parts = (head, np.array([d or 0 for d in doc_ids], "<i8"), counts.astype("<u8"), values.astype("<u4"), known, control, data)
    return b"".join(p.tobytes() for p in parts)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, list]:
    """What :func:`pack` was given: (ids, counts, doc_ids)."""
    magic, n_docs, n, n_values = np.frombuffer(block, "<u8", 4).tolist()
    if magic != _MAGIC:
        raise ValueError("not a block of a token file")
    at = 32

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(block, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, counts, values, known = take("<i8", n_docs), take("<u8", n_docs), take("<u4", n_values), take("u1", n_docs)
    n_bytes = _LENGTHS[take("u1", -(-n // 4))].reshape(-1)[:n]
    data = take("u1", len(block) - at)
    starts = np.cumsum(n_bytes, dtype=np.int64) - n_bytes
    ranks = data[starts].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(n_bytes > k)
        ranks[more] |= data[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values[ranks], counts.astype(np.int64), [d if ok else None for d, ok in zip(doc_ids.tolist(), known.tolist(), strict=True)]


class _Library:
    """Ids of pre-tokens by the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        self.control = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        # The same model over lines that are pre-tokens already.
        self.lines, self.spaces = Tokenizer(whole.model), Tokenizer(whole.model)
        self.spaces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.lines.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), self.spaces.pre_tokenizer])
        # Bytes of each id: one for each character of its string.
        self.n_bytes = np.array([len(whole.id_to_token(i) or "") for i in range(whole.get_vocab_size())], np.int64)
        self.table = Table(self.encode_pieces, spaced=True)

    def encode_pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, offsets) of pre-tokens. Many go to the library in
        one text, a line each (white space, which may hold line ends, goes
        alone); the bytes of ids tell where each line's ids end."""
        plain = [w for w in words if not w.isspace()]
        space = [w for w in words if w.isspace()]
        texts = ["\n".join(plain[k : k + JOINED]) for k in range(0, len(plain), JOINED)]
        found = self.lines.encode_batch_fast(texts, add_special_tokens=False) + self.spaces.encode_batch_fast(space, add_special_tokens=False)
        if not found:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        ids = np.concatenate([np.array(e.ids, np.int64) for e in found])
        sizes = np.array([len(w.encode()) for w in plain + space], np.int64)
        stops = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(sizes), side="left") + 1
        # Back into the order of ``words``.
        is_space = np.array([w.isspace() for w in words])
        order = np.concatenate([np.flatnonzero(~is_space), np.flatnonzero(is_space)])
        begin, lengths = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        begin[order], lengths[order] = np.concatenate([[0], stops[:-1]]), np.diff(stops, prepend=0)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        return ids[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], lengths)], offsets

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return encode_texts(texts, self.table, self.control, lambda t: t)


@functools.lru_cache(2)
def library(path: str) -> _Library:
    return _Library(path)


def _writer(path: str, end_id: int, block_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, before = library(path), TaskContext.get().partitionId(), 0
        ids, counts, docs, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            packed = pack(np.concatenate(ids), np.concatenate(counts), docs)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([held], pa.int64()), pa.array([packed], pa.binary())],
                ["part", "before", "n_tokens", "block"],
            )

        for batch in passes(batches, "text"):
            flat, offsets = tok.encode([t or "" for t in batch.column("text").to_pylist()])
            ids.append(np.insert(flat, offsets[1:], end_id))
            counts.append(np.diff(offsets) + 1)
            docs += batch.column("doc_id").to_pylist()
            held += len(ids[-1])
            if held >= block_tokens:
                yield block()
                before += held
                ids, counts, docs, held = [], [], [], 0
        if docs:
            yield block()

    return write


def write(docs: DataFrame, path: str, target: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the token files of ``docs`` (doc_id, text) to ``target``, in ascending order of doc_id."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    map_batches(rows, _writer(path, end_id, block_tokens), FILES).write.option("compression", "none").parquet(target)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, block in zip(batch.column("start").to_pylist(), batch.column("block"), strict=True):
            ids, counts, doc_ids = unpack(block.as_py())
            ids = ids.astype("<u4")
            ends = np.cumsum(counts)
            sums = [zlib.crc32(ids[e - c : e].tobytes()) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(start + ends - counts), pa.array(counts), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def blocks(spark: SparkSession, source: str) -> DataFrame:
    """(start, block) of the token files: ``start`` counts the ids of all blocks before."""
    files = spark.read.schema(FILES).parquet(source)
    # One row for each written file.
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    shift = parts.select("part", F.expr("coalesce(sum(_n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)").alias("_shift"))
    return files.join(F.broadcast(shift), "part").select((F.col("before") + F.col("_shift")).alias("start"), "block")


def read_index(spark: SparkSession, source: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and ids_crc32."""
    return map_batches(blocks(spark, source), _reader, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", rows=BLOCK_ROWS)


def written_index(docs: DataFrame, path: str) -> DataFrame:
    """Write the token files to the shared folder and read their index back."""
    target = scratch_path(docs.sparkSession, "llm-tokens")
    write(docs, path, target)
    return read_index(docs.sparkSession, target)
