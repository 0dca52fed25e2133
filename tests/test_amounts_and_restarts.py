"""Extreme amounts, late events, restarts without a given checkpoint, complete reports."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tillwright import jobs
from tillwright.config import scratch_path
from tillwright.operators import clean as C
from tillwright.operators import dedup as D
from tillwright.operators import enrich as E
from tillwright.operators import fraud as FR
from tillwright.operators import gold as G
from tillwright.operators import quality as Q
from tillwright.operators.parse import parse_events
from tillwright.plans import lake as L
from tillwright.schemas import MESSAGE_SCHEMA
from tillwright.sources.dims import fx_dim
from tillwright.sources.topic import read_events
from tillwright.streaming import jobs as S


def _event(i, total, price=1.0, **more):
    return {
        "transaction_id": f"t{i}", "event_time": "2026-03-28T10:00:00+00:00", "store_id": "R1", "country": "X", "currency": "USD", "sku": "S",
        "product_name": "p", "category": "c", "unit_price": price, "quantity": 1, "total_amount": total, "payment_method": "card", **more,
    }


def _messages(spark, events):
    return spark.createDataFrame([(e.get("store_id"), json.dumps(e)) for e in events], MESSAGE_SCHEMA)


def test_large_and_small_amounts_neither_abort_nor_vanish(spark):
    events = [_event(i, 0.004) for i in range(1000)] + [_event("big", 1e17), _event("huge", 1e300, price=1e300), _event("inf", float("inf"))]
    parsed = parse_events(_messages(spark, events), full=True, keep_raw=True)
    silver = C.silver(parsed, stamp=False)
    gold = {r["store_id"]: r for r in G.gold_table(silver, G.STORE).collect()}
    assert gold["R1"]["total_revenue"] == 1e17 + 4.0 and gold["R1"]["total_transactions"] == 1001
    small = silver.filter("total_amount < 1")
    assert G.gold_table(small, G.STORE).first()["total_revenue"] == 4.0
    assert G.gold_all(small).filter("gold_table = 'top_products'").first()["total_revenue"] == 4.0
    assert E.usd_revenue(silver, fx_dim(spark), "country").count() == 1
    reasons = {r["transaction_id"]: r["reject_reason"] for r in C.rejects(parsed).collect()}
    assert reasons == {"thuge": "unit_price_over_cap", "tinf": "total_amount_not_finite"}
    late = C.rejects(parsed.withColumn("unit_price", F.lit(1.0))).filter("transaction_id = 'thuge'").first()
    assert late["reject_reason"] == "total_amount_out_of_range"
    codes = {r["transaction_id"]: r["errors"] for r in Q.error_rows(parsed).collect()}
    assert "amount_out_of_range" in codes["thuge"] and "amount_out_of_range" in codes["tinf"] and "amount_out_of_range" not in codes["tbig"]
    assert Q.summary(parsed).first()["n_checked"] == 1003 and Q.total_mismatch_rows(parsed).count() >= 1
    # The six rules alone let the large amount pass; nothing aborts then either.
    assert G.gold_table(C.silver(parsed.withColumn("unit_price", F.lit(1.0)), check_finite=False, stamp=False), G.STORE).count() == 1
    catalogue = spark.createDataFrame([("S", "p", "c", 1.0)], "sku string, product_name string, category string, base_price_usd double")
    catalogue = catalogue.withColumn("base_price_usd", F.col("base_price_usd").cast("decimal(18,2)"))
    assert {r["transaction_id"]: r["fraud_type"] for r in FR.classify(parsed, catalogue, fx_dim(spark)).collect()}["thuge"] == "spike"


def test_dedup_keeps_the_earliest_readable_copy(spark):
    times = ["unreadable", "2026-03-28T10:00:00+02:00", "2026-03-28T09:00:00+00:00", None]
    rows = [("a", t, i) for i, t in enumerate(times)] + [("b", None, 1), ("b", "nonsense", 0)]
    got = D.dedup_transactions(spark.createDataFrame(rows, "transaction_id string, event_time string, n int"))
    assert {r["transaction_id"]: r["n"] for r in got.collect()} == {"a": 1, "b": 1}


def test_stream_dedup_keeps_rows_days_late(spark):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("t-late", "t-late-out", "t-late-ck"))
    days = [28, 1, 27, 2]
    for k, day in enumerate(days):
        events = [_event(f"{day}-{i}", 1.0, event_time=f"2026-03-{day:02d}T10:00:00+00:00") for i in range(5)]
        _messages(spark, [*events, _event("28-0", 1.0), _event(f"none{k}", 1.0, event_time=None)]).coalesce(1).write.mode("append").parquet(topic)
    stream = S.dedup_stream(S.typed_stream(read_events(spark, topic, max_files_per_trigger=1)))
    S.run_until_done(S.start_file_sink(stream, sink, ckpt, partition_by=(), available_now=True))
    got = [r["transaction_id"] for r in spark.read.parquet(sink).collect()]
    assert len(got) == len(set(got)) == 5 * len(days) + len(days)


def test_jobs_resume_their_default_checkpoint(spark, monkeypatch):
    root = scratch_path(spark, "t-resume")
    monkeypatch.setattr(jobs, "configured_dir", lambda _: f"{root}/checkpoints")
    topic = f"{root}/topic"
    runs = {
        "bronze": ["bronze", "--topic", topic, "--out", f"{root}/bronze", "--once"],
        "silver": ["silver", "--topic", topic, "--out", f"{root}/silver", "--rejects", f"{root}/rejects", "--once"],
        "all": ["live-gold", "--topic", topic, "--gold-root", f"{root}/gold", "--once"],
        "one": ["live-gold", "--topic", topic, "--gold-root", f"{root}/gold1", "--table", G.STORE, "--once"],
    }
    for start in (0, 10):
        events = [_event(start + i, 1.0) for i in range(10)] + [_event(f"bad{start}", -1.0)]
        _messages(spark, events).coalesce(1).write.mode("append").parquet(topic)
        for argv in runs.values():
            jobs.main(argv)
    assert spark.read.parquet(f"{root}/bronze").count() == 22
    assert L.read_silver(spark, f"{root}/silver").select("transaction_id").distinct().count() == L.read_silver(spark, f"{root}/silver").count() == 20
    assert spark.read.parquet(f"{root}/rejects").count() == 2
    for gold in ("gold", "gold1"):
        assert L.read_gold(spark, f"{root}/{gold}", G.STORE).first()["total_transactions"] == 20


def test_no_default_checkpoint_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(jobs, "configured_dir", lambda _: None)
    with pytest.raises(SystemExit, match="--checkpoint"):
        jobs.main(["bronze", "--topic", scratch_path(spark, "t-none"), "--out", "x", "--once"])
    with pytest.raises(SystemExit, match="offsets"):
        jobs.main(["bronze", "--topic", scratch_path(spark, "t-none"), "--out", "x", "--starting", "latest", "--once"])


def test_report_prints_every_row_and_old_versions_go(spark, capsys):
    rows = [(f"t{i}", f"S{i:03d}", "p", "X", "USD", 1.0) for i in range(120)]
    silver = spark.createDataFrame(rows, "transaction_id string, store_id string, product_name string, country string, currency string, total_amount double")
    root = scratch_path(spark, "t-versions")
    for _ in range(L.KEEP_VERSIONS + 3):
        L.publish_gold(silver, root)
    jobs.main(["report", "--gold-root", root])
    out = capsys.readouterr().out
    assert all(f"S{i:03d}" in out for i in range(120))
    versions = {r["version"] for r in spark.read.parquet(f"{root}/_manifest").collect()}
    assert len(versions) == L.KEEP_VERSIONS
    assert {p.split("v=")[1].split("/")[0] for p in spark.read.parquet(f"{root}/v=*/gold_table=*").inputFiles()} == versions
