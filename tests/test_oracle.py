"""Every registered query against its DuckDB oracle on the same Parquet tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_harness import compare
from tillwright.oracle import oracle_sql
from tillwright.queries import queries

QUERIES = queries()
SQL = oracle_sql()

# At sf0.001 two different lines share one id, so which copy a streaming
# dedup keeps is arrival order; that key is checked by row count below, and
# ``stream_dedup_batches`` compares the columns that an id determines.
ORDER_DEPENDENT = {"stream_dedup"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(k for k in SQL if k not in ORDER_DEPENDENT))
def test_query_matches_oracle(spark, duck_small, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], duck_small)
    assert res["status"] == "match", res


def test_stream_dedup_keeps_one_row_per_id(spark, duck_small):
    res = compare(spark, SF_SMALL, "stream_dedup", QUERIES["stream_dedup"], SQL["stream_dedup"], duck_small)
    assert res["spark_rows"] == res["duck_rows"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["country", "currency", "total_transactions", "total_revenue"]


def test_messages_are_keyed_json_in_producer_order(spark):
    import json

    from tillwright.schemas import EVENT_FIELDS
    from tillwright.sources.ledger import ledger
    from tillwright.sources.topic import to_messages

    rows = to_messages(ledger(spark, SF_SMALL)).collect()
    assert len(rows) == 6000
    order = [n for n, _ in EVENT_FIELDS]
    for r in rows[:50]:
        event = json.loads(r["value"])
        assert r["key"] == event["store_id"] and event["event_time"].endswith("+00:00")
        assert list(event) == [n for n in order if n in event]


def test_a_stores_messages_are_in_time_order_within_a_task(spark):
    from pyspark.sql import functions as F

    from tillwright.sources.ledger import ledger
    from tillwright.sources.topic import to_messages

    sent = to_messages(ledger(spark, SF_SMALL)).select(
        "key", F.get_json_object("value", "$.event_time").alias("t"), F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i")
    )
    last = {}
    for r in sorted(sent.collect(), key=lambda r: r["i"]):
        assert last.get((r["p"], r["key"]), "") <= r["t"]
        last[r["p"], r["key"]] = r["t"]
