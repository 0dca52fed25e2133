"""Where the streaming dedup keeps its ids."""

from __future__ import annotations

import json

import pytest

from tillwright.config import scratch_path
from tillwright.schemas import MESSAGE_SCHEMA
from tillwright.sources.topic import read_events
from tillwright.streaming import jobs as S

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def send(spark, topic, ids):
    rows = [("R1", json.dumps({"transaction_id": i, "store_id": "R1"})) for i in ids]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(topic)


def run(spark, topic, sink, ckpt):
    """Runs the dedup on what is new; whether its state lay in RocksDB."""
    stream = S.dedup_stream(S.typed_stream(read_events(spark, topic)))
    q = S.run_until_done(S.start_file_sink(stream, sink, ckpt, partition_by=(), available_now=True))
    return any(k.startswith("rocksdb") for k in q.lastProgress["stateOperators"][0]["customMetrics"])


@pytest.fixture(autouse=True)
def unset(spark):
    """The jobs' own tests leave a provider in the session."""
    own = spark.conf.get(PROVIDER, None)
    spark.conf.unset(PROVIDER)
    yield
    if own is not None:
        spark.conf.set(PROVIDER, own)


@pytest.mark.parametrize("first", [None, ON_HEAP])
def test_ids_lie_on_disk_unless_the_session_or_the_checkpoint_says_otherwise(spark, first):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("t-state-topic", "t-state", "t-state-ckpt"))
    send(spark, topic, ["a", "b", "a", None])
    if first:
        spark.conf.set(PROVIDER, first)
    try:
        assert run(spark, topic, sink, ckpt) == (first is None)
        assert spark.conf.get(PROVIDER, None) == first
    finally:
        spark.conf.unset(PROVIDER)
    # A restart goes on with the state there is.
    send(spark, topic, ["b", "c", "c"])
    assert run(spark, topic, sink, ckpt) == (first is None)
    assert sorted(r["transaction_id"] for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]
    assert spark.conf.get(PROVIDER, None) is None
