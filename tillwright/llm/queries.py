"""Registered queries of this package: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, decontam, divergence, htmlcrf, interaction, minhash, quality, secrets, sharding, sigtree, tokenfile, urls
from .common import read


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    judged = urls.judged(pages, urls.page_labels(pages, read(spark, sf_dir, "labels")))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.STATISTICS, "base_failed", "kept", "score")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.search(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    field = htmlcrf.trained(htmlcrf.labelled_pages(pages, read(spark, sf_dir, "documents")))
    return htmlcrf.extracted(pages.select("page_id", "url", "html"), field).drop("html")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.written_index(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encoded(docs, vocabulary("word_bpe_49k.json"))).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(read(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id bigint, turn bigint, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.read_back(chat.written(turns, vocabulary("byte_bpe_50k.json")))


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.jaccard_join(read(spark, sf_dir, "documents")).drop("set_key")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
