"""Batch tables: one commit per batch, compaction, expiry, incremental gold, file skipping."""

from __future__ import annotations

import glob
import json

import pytest
from pyspark.sql import functions as F

from tillwright import jobs
from tillwright.config import scratch_path
from tillwright.operators import gold as G
from tillwright.plans import batches as B
from tillwright.plans import lake as L
from tillwright.plans import manifest
from tillwright.schemas import MESSAGE_SCHEMA, SPLIT_SCHEMA
from tillwright.sources.topic import read_events
from tillwright.streaming import jobs as S


def publish(spark, topic, ids, country="X", price=2.0):
    events = [
        {"transaction_id": i, "event_time": "2026-03-28T10:00:00+00:00", "store_id": f"S{k % 7}", "product_name": "p", "unit_price": price,
         "quantity": 1, "total_amount": price, "country": country, "currency": "USD"}
        for k, i in enumerate(ids)
    ]
    spark.createDataFrame([("s", json.dumps(e)) for e in events], MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(topic)


def run(spark, topic, root, ckpt, files=1):
    stream = S.split_stream(read_events(spark, topic, max_files_per_trigger=files))
    S.run_until_done(S.start_batch_sink(stream, root, ckpt, available_now=True))


def ids(spark, root, dataset):
    return sorted(r["transaction_id"] for r in B.read(spark, root, SPLIT_SCHEMA, dataset).collect())


def split_of(spark, n_files=3):
    topic, root, ckpt = (scratch_path(spark, n) for n in ("t-b-topic", "t-b", "t-b-ckpt"))
    for k in range(n_files):
        publish(spark, topic, [f"g{k}-{i}" for i in range(20)], country=f"C{k % 2}")
        publish(spark, topic, [f"bad{k}"], price=-1.0)
    return topic, root, ckpt


def silver_rows(spark, n, start=0, seed=0):
    k = F.col("id")
    cols = {
        "transaction_id": F.concat(F.lit("t"), k.cast("string")), "event_time": F.timestamp_add("SECOND", k.cast("int"), F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")),
        "store_id": F.format_string("R%04d", k % 50), "product_name": F.when(k % 11 > 0, F.concat(F.lit("p"), (k % 13).cast("string"))), "unit_price": F.lit(1.0),
        "quantity": F.lit(1), "total_amount": (k % 97) / 100.0 + 0.004, "currency": F.when(k % 3 > 0, F.lit("USD")).otherwise("EUR"), "processed_time": F.current_timestamp(),
        "country": F.when(k % 5 < 4, F.lit("hot")).when(k % 10 == 4, F.lit("cold")), "reject_reason": F.lit(None).cast("string"), "dataset": F.lit("silver"),
    }
    return spark.range(start, start + n).select(*[c.alias(n) for n, c in cols.items()])


def test_failure_before_the_commit_loses_and_repeats_nothing(spark, monkeypatch):
    topic, root, ckpt = split_of(spark)
    commit, calls = B._commit, []

    def fails_once(*args):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("lost")
        commit(*args)

    monkeypatch.setattr(B, "_commit", fails_once)
    with pytest.raises(Exception, match="lost"):
        run(spark, topic, root, ckpt)
    assert len(B.state(spark, root).live) == 2
    run(spark, topic, root, ckpt)
    good = sorted(f"g{k}-{i}" for k in range(3) for i in range(20))
    assert ids(spark, root, "silver") == good and ids(spark, root, "rejects") == ["bad0", "bad1", "bad2"]


def test_failure_after_the_commit_repeats_nothing(spark, monkeypatch):
    topic, root, ckpt = split_of(spark)
    append = B.append

    def fails_late(*args):
        append(*args)
        raise OSError("lost")

    monkeypatch.setattr(B, "append", fails_late)
    with pytest.raises(Exception, match="lost"):
        run(spark, topic, root, ckpt)
    monkeypatch.setattr(B, "append", append)
    run(spark, topic, root, ckpt)
    assert len(ids(spark, root, "silver")) == len(set(ids(spark, root, "silver"))) == 60 and len(ids(spark, root, "rejects")) == 3


def test_a_new_checkpoint_is_another_writer(spark):
    root = scratch_path(spark, "t-b-writers")
    rows = silver_rows(spark, 5)
    assert B.append(rows, root, "a", 0) and B.append(rows, root, "b", 0)
    assert B.append(rows, root, "a", 0) is None and B.append(rows, root, "a", 1)
    assert [r["lo"] for r in B.state(spark, root).live.values()] == [0, 1, 2]


def test_compaction_under_readers_and_a_restarted_stream(spark):
    topic, root, ckpt = split_of(spark, 6)
    run(spark, topic, root, ckpt)
    before = ids(spark, root, "silver")
    held = B.read(spark, root, SPLIT_SCHEMA)  # planned before, run after
    assert len(held.inputFiles()) == 12
    path = B.compact(spark, root, SPLIT_SCHEMA)
    files = glob.glob(path.replace("file:", "") + "/**/*.parquet", recursive=True)
    assert len([f for f in files if "_ranges" not in f]) <= 4  # one range of rows; a file for each data set and country
    assert held.count() == 126 and ids(spark, root, "silver") == before
    publish(spark, topic, ["late"])
    run(spark, topic, root, ckpt)
    assert ids(spark, root, "silver") == sorted([*before, "late"]) and B.compact(spark, root, SPLIT_SCHEMA)
    assert B.compact(spark, root, SPLIT_SCHEMA) is None


def test_files_follow_the_bytes(spark):
    root = scratch_path(spark, "t-b-bytes")
    for k in range(4):
        B.append(silver_rows(spark, 20_000, start=20_000 * k), root, "load", k)
    size = sum(B.size(spark, p) for p in B.state(spark, root).live)
    path = B.compact(spark, root, SPLIT_SCHEMA, target_bytes=size // 8)
    files = [f for f in glob.glob(path.replace("file:", "") + "/dataset=*/**/*.parquet", recursive=True)]
    assert 8 <= len(files) <= 9 + 3  # the ranges and the borders of three countries
    hot = [f for f in files if "country=hot" in f]
    assert len(hot) >= 5  # four fifths of the rows, cut along the stores


def test_of_two_compactions_at_a_time_one_counts(spark, monkeypatch):
    root = scratch_path(spark, "t-b-race")
    for k in range(3):
        B.append(silver_rows(spark, 10, start=10 * k), root, "load", k)
    stale = B.state(spark, root)
    assert B.compact(spark, root, SPLIT_SCHEMA)
    real, calls = B.state, []

    def seen_before(*args):
        calls.append(1)
        return stale if len(calls) == 1 else real(*args)

    monkeypatch.setattr(B, "state", seen_before)
    assert B.compact(spark, root, SPLIT_SCHEMA) is None
    monkeypatch.setattr(B, "state", real)
    assert B.read(spark, root, SPLIT_SCHEMA, "silver").count() == 30


def test_an_append_that_lost_its_number_tries_again(spark, monkeypatch):
    root = scratch_path(spark, "t-b-number")
    stale = B.state(spark, root)
    B.append(silver_rows(spark, 10), root, "a", 0)
    real, calls = B.state, []

    def seen_before(*args):
        calls.append(1)
        return stale if len(calls) == 1 else real(*args)

    monkeypatch.setattr(B, "state", seen_before)
    assert B.append(silver_rows(spark, 10, start=10), root, "b", 0)
    monkeypatch.setattr(B, "state", real)
    assert sorted(r["lo"] for r in B.state(spark, root).live.values()) == [0, 1]
    assert B.read(spark, root, SPLIT_SCHEMA, "silver").select("transaction_id").distinct().count() == 20


def test_expiry_keeps_the_state(spark):
    topic, root, ckpt = split_of(spark, 4)
    run(spark, topic, root, ckpt)
    B.compact(spark, root, SPLIT_SCHEMA)
    before, was = ids(spark, root, "silver"), B.state(spark, root)
    assert B.expire(spark, root, older_than_s=3600) == 0  # nothing is that old
    spark.range(1).write.parquet(f"{root}/data/_folder=orphan")
    assert B.expire(spark, root, older_than_s=-5) == len(was.replaced) + 1
    now = B.state(spark, root)
    assert set(now.live) == set(was.live) and now.last == was.last and now.writers == was.writers
    assert len(glob.glob(f"{root}/_commits/*.parquet".replace("file:", ""))) == 1
    publish(spark, topic, ["more"])
    run(spark, topic, root, ckpt)
    run(spark, topic, root, ckpt)
    assert ids(spark, root, "silver") == sorted([*before, "more"])


def test_log_order_decides_and_snapshots_stand_for_what_they_fold():
    def row(kind, seq, path, lo=0, hi=0, writer=None, batch=None, replaces=()):
        return {"kind": kind, "seq": seq, "path": path, "lo": lo, "hi": hi, "writer": writer, "writer_batch": batch, "replaces": list(replaces), "committed_at": seq}

    log = [row("append", 0, "a", 0, 0, "w", 0), row("append", 1, "b", 1, 1, "w", 1), row("compact", 2, "c", 0, 1, replaces=["a", "b"])]
    assert set(B.replay(log).live) == {"c"}
    assert set(B.replay([*log, row("compact", 3, "d", 0, 1, replaces=["a", "b"])]).live) == {"c"}
    snapshot = [row("base", 2, "c", 0, 1), row("writer", 2, None, 1, 1, "w", 1)]
    later = row("append", 3, "e", 2, 2, "w", 2)
    for some in ([], log[:1], log[1:], log):
        entries = sorted([*some, *snapshot, later], key=lambda r: (r["seq"], r["kind"] not in ("base", "writer")))
        assert set(B.replay(entries).live) == {"c", "e"} and B.replay(entries).writers == {"w": 2}


def test_incremental_gold_reads_only_new_files(spark, monkeypatch):
    table, root = scratch_path(spark, "t-b-inc"), scratch_path(spark, "t-b-inc-gold")
    read, files = B.read, []

    def spied(*args, **kwargs):
        df = read(*args, **kwargs)
        files.append({f.split("_folder=")[1].split("/")[0][:12] for f in df.inputFiles()})
        return df

    monkeypatch.setattr(B, "read", spied)
    for k in range(3):
        B.append(silver_rows(spark, 500, start=500 * k), table, "load", k)
        assert L.publish_incremental(spark, table, root, SPLIT_SCHEMA)
    assert files == [{f"{k:012d}"} for k in range(3)]
    assert L.publish_incremental(spark, table, root, SPLIT_SCHEMA) is None
    whole = {tuple(r) for r in G.gold_all(silver_rows(spark, 1500)).collect()}
    assert {tuple(r) for r in G.tagged_gold(L.read_gold_tables(spark, root)).select(*G.gold_all(silver_rows(spark, 1)).columns).collect()} == whole


def test_incremental_gold_over_compactions_failures_and_empty_batches(spark, monkeypatch):
    table, root = scratch_path(spark, "t-b-inc2"), scratch_path(spark, "t-b-inc2-gold")
    B.append(silver_rows(spark, 300), table, "load", 0)
    L.publish_incremental(spark, table, root, SPLIT_SCHEMA)
    B.append(silver_rows(spark, 300, start=300), table, "load", 1)
    B.append(silver_rows(spark, 0), table, "load", 2)
    B.compact(spark, table, SPLIT_SCHEMA)  # one file holds counted and new rows
    commit = manifest.commit
    monkeypatch.setattr(manifest, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        L.publish_incremental(spark, table, root, SPLIT_SCHEMA)
    monkeypatch.setattr(manifest, "commit", commit)
    L.publish_incremental(spark, table, root, SPLIT_SCHEMA)
    B.append(silver_rows(spark, 0), table, "load", 3)
    L.publish_incremental(spark, table, root, SPLIT_SCHEMA)
    columns = G.gold_all(silver_rows(spark, 1)).columns
    got = {tuple(r) for r in G.tagged_gold(L.read_gold_tables(spark, root)).select(*columns).collect()}
    assert got == {tuple(r) for r in G.gold_all(silver_rows(spark, 600)).collect()}


def test_one_stores_rows_come_from_few_files(spark):
    root = scratch_path(spark, "t-b-skip")
    for k in range(3):
        B.append(silver_rows(spark, 10_000, start=10_000 * k), root, "load", k)
    size = sum(B.size(spark, p) for p in B.state(spark, root).live)
    B.compact(spark, root, SPLIT_SCHEMA, target_bytes=size // 10)
    B.append(silver_rows(spark, 100, start=30_000), root, "load", 3)  # not compacted: read whole
    paths, skipped = B.files_with(spark, root, "store_id", "R0007", "silver")
    assert skipped >= 8 and len(paths) <= 5
    rows = B.read_where(spark, root, SPLIT_SCHEMA, "store_id", "R0007", "silver")
    assert rows.count() == B.read(spark, root, SPLIT_SCHEMA, "silver").filter("store_id = 'R0007'").count() == 602
    assert B.read_where(spark, root, SPLIT_SCHEMA, "store_id", "none", "silver").count() == 0


def test_jobs_split_compact_and_gold(spark, capsys):
    topic, root, ckpt = split_of(spark)
    args = ["split", "--topic", topic, "--out", root, "--checkpoint", ckpt, "--once"]
    gold = ["gold", "--table", root, "--gold-root", f"{root}-gold"]
    for argv in (args, gold, ["compact", "--table", root], args, gold):
        jobs.main(argv)
    assert "up to date" in capsys.readouterr().out
    assert sum(r["total_transactions"] for r in L.read_gold(spark, f"{root}-gold", G.COUNTRY).collect()) == 60


def test_a_failed_side_query_is_raised(spark, monkeypatch):
    topic, root, ckpt = split_of(spark, 1)
    ok = S.start_file_sink(S.silver_stream(read_events(spark, topic)), f"{root}-ok", f"{ckpt}-ok", interval="1 second")
    monkeypatch.setattr(B, "append", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    bad = S.start_batch_sink(S.split_stream(read_events(spark, topic)), root, ckpt, available_now=True)
    with pytest.raises(RuntimeError, match="failed"):
        S.run_all_until_done([ok, bad])
    assert not ok.isActive


def test_a_compaction_plans_tasks_by_rows_whatever_the_file_size(spark, monkeypatch):
    root = scratch_path(spark, "t-b-rows")
    for k in range(2):
        B.append(silver_rows(spark, 1000, 1000 * k), root, "w", k)
    planned = []
    real = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda df, n, *c: planned.append(n) or real(df, n, *c))
    monkeypatch.setattr(B, "ROWS_PER_TASK", 500)
    path = B.compact(spark, root, SPLIT_SCHEMA, target_bytes=1024)
    assert planned == [4]  # not one for each kilobyte
    ranges = spark.read.parquet(f"{path}/_ranges").collect()
    assert len(ranges) > 20 and sum(r["n_rows"] for r in ranges) == 2000
    assert len(ids(spark, root, "silver")) == 2000


def test_only_files_to_read_come_to_the_driver(spark, monkeypatch):
    root = scratch_path(spark, "t-b-hits")
    for k in range(2):
        B.append(silver_rows(spark, 1000, 1000 * k), root, "w", k)
    B.compact(spark, root, SPLIT_SCHEMA, target_bytes=1024)
    rows, real = [], type(spark.range(1)).collect

    def collect(df):
        found = real(df)
        if "file" in df.columns and "kind" not in df.columns:
            rows.extend(found)
        return found

    monkeypatch.setattr(type(spark.range(1)), "collect", collect)
    paths, skipped = B.files_with(spark, root, "store_id", "R0007", "silver")
    assert len(rows) == len(paths) and skipped > 0
