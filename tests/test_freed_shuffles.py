"""Shuffle files go with the write or the micro-batch they belong to, so that a query's disk does not add up over its steps."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillwright import queries as Q
from tillwright.config import FREED_SHUFFLES, scratch_path, session_settings, shared_dir
from tillwright.operators.sequence import numbered
from tillwright.plans import batches as B
from tillwright.plans import idindex as IX
from tillwright.plans.files import children, exists
from tillwright.schemas import MESSAGE_SCHEMA, SPLIT_SCHEMA
from tillwright.sources.topic import read_events, write_topic
from tillwright.streaming import jobs as S


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def left_by(spark, work):
    """Shuffle files that ``work`` leaves, once those that go have gone."""
    before = shuffle_files(spark)
    work()
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_a_written_topic_leaves_no_shuffle_files(spark):
    rows = spark.createDataFrame([(str(i), "{}") for i in range(40)], MESSAGE_SCHEMA).repartition(3, "key")
    topic = scratch_path(spark, "t-freed")
    assert not left_by(spark, lambda: write_topic(rows, topic)) and spark.read.parquet(topic).count() == 40


def test_numbering_leaves_its_laid_out_rows_only(spark):
    rows = spark.range(60).select((F.col("id") % 7).alias("key"), "id").repartition(3, "key")
    held = {}
    assert not left_by(spark, lambda: held.update(out=numbered(rows, "key", ["id"])))
    folders = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p, _ in children(spark, shared_dir(spark))}
    assert "numbered" in folders and "unnumbered" not in folders
    assert all(r["seq"] == r["id"] // 7 + 1 for r in held["out"].collect())


def test_a_dealt_topic_is_written_a_micro_batch_at_a_time(spark, monkeypatch):
    writes, write = [], Q.write_topic
    monkeypatch.setattr(Q, "write_topic", lambda rows, path: (writes.append(path), write(rows, path))[1])
    monkeypatch.setattr(Q, "MESSAGES_PER_FILE", 1000)
    sent = Q._messages(spark, SF_SMALL)
    topic, files = Q._dealt(spark, SF_SMALL, sent, 4, copies=2)
    assert files == 3 and writes == [writes[0], *[topic] * 4] and not exists(spark, writes[0])
    names = [p for p, _ in sorted(children(spark, topic), key=lambda c: c[1]) if p.endswith(".parquet")]
    assert len(names) == 4 * files
    got = spark.read.parquet(topic).groupBy("key", "value").count()
    want = sent.groupBy("key", "value").agg((2 * F.count("*")).alias("count"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # Most copies lie in another micro-batch than their first.
    rows = spark.read.parquet(topic).select("value", F.col("_metadata.file_path").alias("file"))
    assert rows.groupBy("value").agg(F.count_distinct("file").alias("n")).filter("n = 2").count() > 4000


def test_dedup_by_index_leaves_the_table_only(spark, monkeypatch):
    root = scratch_path(spark, "t-freed-index")
    rows = spark.createDataFrame([(f"i{i % 50}", i) for i in range(90)], "transaction_id string, n int")
    probes = []
    monkeypatch.setattr(IX, "probed", lambda *a, real=IX.probed: probes.append(1) or real(*a))

    def run():
        IX.append_new(rows.filter("n < 40").repartition(3), root, "w", 0)
        IX.append_new(rows.repartition(3), root, "w", 1)

    assert not left_by(spark, run) and probes == [1]
    assert all("/_folder=" in p for p, _ in children(spark, f"{root}/data"))
    got = IX.read(spark, root, rows.schema).collect()
    assert sorted((r["transaction_id"], r["n"]) for r in got) == sorted((f"i{i}", i) for i in range(50))
    monkeypatch.setattr(B, "append", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        IX.append_new(rows, root, "w", 2)
    assert all("/_folder=" in p for p, _ in children(spark, f"{root}/data"))


def test_an_appended_batch_leaves_no_shuffle_files(spark):
    rows = spark.range(30).select("id", F.lit("R1").alias("country"), F.lit("silver").alias(B.DATASET)).repartition(3, "id")
    assert not left_by(spark, lambda: B.append(rows, scratch_path(spark, "t-freed-batch"), "w", 0))


def test_micro_batches_and_a_compaction_leave_no_shuffle_files(spark):
    topic, (root, ckpt) = Q._topic(spark, SF_SMALL), (scratch_path(spark, n) for n in ("t-freed-split", "t-freed-ckpt"))
    split = S.split_stream(read_events(spark, topic, max_files_per_trigger=3))
    assert not left_by(spark, lambda: S.run_until_done(S.start_batch_sink(split, root, ckpt, available_now=True)))
    n = spark.read.parquet(topic).count()
    assert not left_by(spark, lambda: B.compact(spark, root, SPLIT_SCHEMA))
    assert B.read(spark, root, SPLIT_SCHEMA).count() == n and len(B.state(spark, root).live) == 1


@pytest.mark.parametrize("own", [None, "false", "true"])
def test_the_session_has_its_own_settings_afterwards(spark, own):
    key = next(iter(FREED_SHUFFLES))
    if own is not None:
        spark.conf.set(key, own)
    try:
        with pytest.raises(OSError), session_settings(spark, FREED_SHUFFLES):
            assert spark.conf.get(key) == "true"
            raise OSError
        assert spark.conf.get(key, None) == own
    finally:
        spark.conf.unset(key)
    assert spark.range(3).agg(F.sum("id")).first()[0] == 3
