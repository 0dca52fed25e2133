"""Streaming = batch on the same input; restarts add nothing."""

from __future__ import annotations

from tillwright.config import scratch_path
from tillwright.operators import clean as C
from tillwright.operators import gold as G
from tillwright.operators.parse import parse_events
from tillwright.plans import lake as L
from tillwright.schemas import BRONZE_READ_SCHEMA, PARSED_FIELDS
from tillwright.sources.ledger import ledger
from tillwright.sources.topic import read_events, read_events_batch, to_messages, write_topic
from tillwright.streaming import jobs as S

from conftest import SF_SMALL


def _topic(spark):
    path = scratch_path(spark, "t-topic")
    write_topic(to_messages(ledger(spark, SF_SMALL)).repartition(6), path)
    return path


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def test_bronze_stream_equals_batch_and_restart_adds_nothing(spark):
    topic = _topic(spark)
    sink, ckpt = scratch_path(spark, "t-bronze"), scratch_path(spark, "t-ckpt")
    for _ in range(2):
        stream = S.bronze_stream(read_events(spark, topic, max_files_per_trigger=2))
        q = S.run_until_done(S.start_file_sink(stream, sink, ckpt, available_now=True))
    assert q.lastProgress is None or q.lastProgress["numInputRows"] == 0
    batch = parse_events(read_events_batch(spark, topic))
    got = L.read_bronze(spark, sink, BRONZE_READ_SCHEMA)
    assert _rows(got, PARSED_FIELDS) == _rows(batch, PARSED_FIELDS)


def test_new_files_after_restart_are_read_once(spark):
    topic = _topic(spark)
    sink, ckpt = scratch_path(spark, "t-bronze"), scratch_path(spark, "t-ckpt")

    def run():
        stream = S.bronze_stream(read_events(spark, topic))
        S.run_until_done(S.start_file_sink(stream, sink, ckpt, partition_by=(), available_now=True))

    run()
    first = spark.read.parquet(sink).count()
    write_topic(to_messages(ledger(spark, SF_SMALL)), topic)  # a second delivery arrives
    run()
    assert spark.read.parquet(sink).count() == 2 * first


def test_live_gold_equals_batch_gold(spark):
    topic = _topic(spark)
    root, ckpt = scratch_path(spark, "t-live"), scratch_path(spark, "t-ckpt")
    stream = S.silver_stream(read_events(spark, topic, max_files_per_trigger=2))
    S.run_until_done(S.start_live_gold(stream, G.STORE, root, ckpt, available_now=True))
    live = L.read_gold(spark, root, G.STORE)
    batch = G.revenue_by_store(C.silver(parse_events(read_events_batch(spark, topic)), stamp=False))
    cols = ["store_id", "country", "total_revenue", "total_transactions"]
    assert _rows(live, cols) == _rows(batch, cols)
    # every micro-batch committed a complete version; the manifest has them all
    versions = spark.read.parquet(f"{root}/_manifest").count()
    assert versions >= 3


def test_stream_dedup_drops_resent_events(spark):
    topic = _topic(spark)
    write_topic(to_messages(ledger(spark, SF_SMALL)), topic)  # every event re-sent
    sink, ckpt = scratch_path(spark, "t-dedup"), scratch_path(spark, "t-ckpt")
    stream = S.dedup_stream(S.typed_stream(read_events(spark, topic)))
    S.run_until_done(S.start_file_sink(stream, sink, ckpt, partition_by=(), available_now=True))
    got = spark.read.parquet(sink)
    ids = got.select("transaction_id").distinct().count()
    assert got.count() == ids
    expected = parse_events(read_events_batch(spark, topic)).filter("transaction_id IS NOT NULL")
    assert ids == expected.select("transaction_id").distinct().count()


def test_console_tail_prints_parsed_events(spark, capfd):
    import json

    from tillwright.schemas import MESSAGE_SCHEMA

    topic = scratch_path(spark, "t-console")
    rows = [("R1", json.dumps({"transaction_id": f"c{i}", "store_id": "R1", "quantity": i})) for i in range(3)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).write.parquet(topic)
    q = S.start_console(S.bronze_stream(read_events(spark, topic)), scratch_path(spark, "t-ckpt"), available_now=True)
    S.run_until_done(q)
    assert q.lastProgress["numInputRows"] == 3


def test_one_streaming_query_keeps_all_three_gold_tables(spark):
    topic = _topic(spark)
    root, ckpt = scratch_path(spark, "t-live-all"), scratch_path(spark, "t-ckpt")
    stream = S.silver_stream(read_events(spark, topic, max_files_per_trigger=2))
    S.run_until_done(S.start_live_gold_all(stream, root, ckpt, available_now=True))
    silver = C.silver(parse_events(read_events_batch(spark, topic)), stamp=False)
    for name in G.GOLD_TABLES:
        live = L.read_gold(spark, root, name)
        cols = live.columns
        assert _rows(live, cols) == _rows(G.gold_table(silver, name), cols), name


def test_dedup_across_micro_batches_within_the_watermark(spark):
    import json

    from tillwright.schemas import MESSAGE_SCHEMA

    def msgs(ids, minute):
        return spark.createDataFrame(
            [
                ("R1", json.dumps({"transaction_id": t, "event_time": f"2026-03-28T10:{minute:02d}:00+00:00", "store_id": "R1"}))
                for t in ids
            ],
            MESSAGE_SCHEMA,
        )

    topic = scratch_path(spark, "t-dedup-topic")
    sink, ckpt = scratch_path(spark, "t-dedup-sink"), scratch_path(spark, "t-ckpt")

    def run():
        stream = S.dedup_stream(S.typed_stream(read_events(spark, topic)), delay="1 hour")
        S.run_until_done(S.start_file_sink(stream, sink, ckpt, partition_by=(), available_now=True))

    msgs(["a", "b", "c"], 0).write.mode("append").parquet(topic)
    run()
    # re-sends of a and b ten minutes later, plus a new id: within the delay
    msgs(["a", "b", "d"], 10).write.mode("append").parquet(topic)
    run()
    got = sorted(r.transaction_id for r in spark.read.parquet(sink).collect())
    assert got == ["a", "b", "c", "d"]


def test_a_large_topic_has_more_files_not_more_batches(spark, monkeypatch):
    from tillwright import queries as Q
    from tillwright.plans.files import children

    def n_files(topic):
        return sum(p.endswith(".parquet") for p, _ in children(spark, topic))

    small, one = Q._dealt(spark, SF_SMALL, Q._messages(spark, SF_SMALL), 4)
    assert one == 1 and n_files(small) == 4
    monkeypatch.setattr(Q, "MESSAGES_PER_FILE", 500)
    large, each = Q._dealt(spark, SF_SMALL, Q._messages(spark, SF_SMALL), 4)
    assert each >= 3 and n_files(large) == 4 * each
    assert Q._files_per_batch(spark, small, 3) == 3
    monkeypatch.setattr(Q, "MICRO_BATCHES", 2)
    assert Q._files_per_batch(spark, large, 3) == 2 * each
    a, b = (spark.read.parquet(t) for t in (small, large))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
