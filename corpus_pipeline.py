"""The corpus pipeline: quality rules, near-dedup, benchmark decontamination, secret scans, BPE.

``STAGES`` lists (name, function) with ``function(spark, docs, sf_dir)``. Each
stage works on all documents that the stage before kept; its result is written
as Parquet and read again. All stages but the last return the columns of
``documents``; the last returns what encoding gives for each document.

Defined results: an empty table passes through as an empty table; other
columns of ``documents`` are kept, whatever their names;
rows that repeat a ``doc_id`` are judged each by their own text, and of rows
with equal ``doc_id`` and equal shingles one stays; a null text fails the
quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import bpe, decontam, minhash, quality, secrets
from tillwright.llm.common import read, staged
from tillwright.llm.queries import vocabulary


def _bare(docs: DataFrame) -> DataFrame:
    """doc_id and text as they are, other columns under names that no operator uses."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"_c{i}") for i, c in enumerate(docs.columns)])


def _named(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their names again."""
    return df.select(*[F.col(c if c in ("doc_id", "text") else f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram ratio."""
    return _named(quality.quality(_bare(docs), read(spark, sf_dir, "labels")).filter("kept"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id (of several texts under that id, one)."""
    bare = _bare(docs)
    kept = minhash.near_duplicates(bare).filter("kept AND set_key = root_key")
    kept = kept.select(F.col("doc_id").alias("_kept"), F.col("text_key").alias("_text"), F.col("set_key").alias("_set")).distinct()
    mine = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.xxhash64("text") == F.col("_text"))
    return _named(bare.join(kept, mine).dropDuplicates(["doc_id", "_set"]), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return _named(decontam.search(_bare(docs), read(spark, sf_dir, "benchmark")).filter("NOT contaminated"), docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and ``n_chars`` counted anew."""
    masked = _named(secrets.masked(secrets.scan(_bare(docs))), docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    encoded = bpe.encoded(docs.select("doc_id", "text"), vocabulary("word_bpe_49k.json"))
    return bpe.digests(encoded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("bpe", encoding),
]

#: MinHash, suffix arrays, novelty and BPE are not SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    df = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        df = staged(stage(spark, df, sf_dir), f"pipeline-{name}")
    return df
