"""Plan shape: pushdown, pruning, broadcast only of small sides, one scan for gold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from tillwright.operators import clean as C
from tillwright.operators import gold as G
from tillwright.queries import queries as library_queries
from tillwright.sources.ledger import bronze_rows
from tillwright.sources.tables import broadcast_if_small, table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_lineitem_scan_is_pruned_and_filtered(spark):
    for full, key in ((True, "l_orderkey"), (False, "l_partkey")):
        silver = C.silver(bronze_rows(spark, SF_SMALL, full=full), stamp=False)
        text = _formatted(G.revenue_by_country(silver) if not full else silver)
        scan = text[text.index("lineitem.parquet") - 400 :]
        assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double" in scan
        assert "l_extendedprice" not in scan.split("ReadSchema")[1].split("\n")[0]
        assert f"IsNotNull({key})" in scan.split("PushedFilters")[1].split("\n")[0]


def test_facts_are_never_broadcast(spark):
    plan = _plan(C.silver(bronze_rows(spark, SF_SMALL, full=True), stamp=False)).split("\n")
    scan = next(i for i, line in enumerate(plan) if "FileScan parquet [l_orderkey" in line)
    exchange = next(line for line in reversed(plan[:scan]) if "Exchange" in line)
    # where orders are joined, the facts are hash-shuffled on the order key, never broadcast
    assert "Exchange hashpartitioning(l_orderkey" in exchange and "Broadcast" not in exchange
    assert sum("BroadcastExchange" in line for line in plan) >= 5  # the dimensions are


def test_pruned_facts_are_not_moved(spark):
    """Without order columns the facts meet only broadcast dimensions: no exchange above their scan."""
    plan = _plan(C.silver(bronze_rows(spark, SF_SMALL), stamp=False)).split("\n")
    scan = next(i for i, line in enumerate(plan) if "FileScan parquet [l_orderkey" in line)
    assert not any("Exchange" in line for line in plan[:scan])
    assert sum("BroadcastExchange" in line for line in plan) >= 5


def test_gold_all_aggregates_before_grouping_sets(spark):
    """The rows are reduced by a partial and a final aggregation before Expand triples what is left."""
    text = _plan(G.gold_all(C.silver(bronze_rows(spark, SF_SMALL), stamp=False)))
    below = text[text.index("Expand") :]
    assert below.count("HashAggregate") >= 2 and "partial_sum" in below


def test_gold_all_scans_silver_once(spark):
    silver = C.silver(bronze_rows(spark, SF_SMALL), stamp=False)
    text = _formatted(G.gold_all(silver))
    assert text.count("lineitem.parquet") == 1
    assert "Expand" in text


# Queries that write and read back when called; their operators' plans are checked as batch twins and streams.
RUN_JOBS = ("stream_", "scan_", "gold_views", "gold_roundtrip", "csv_")


@pytest.mark.parametrize("name", sorted(n for n in library_queries() if not n.startswith(RUN_JOBS)))
def test_no_python_udf_in_any_query(spark, name):
    plan = _plan(library_queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert bad not in plan, name


def test_broadcast_if_small_respects_the_bound(spark):
    nation = table(spark, SF_SMALL, "nation")
    assert "broadcast" in broadcast_if_small(nation, 100)._jdf.queryExecution().analyzed().toString().lower()
    big = table(spark, SF_SMALL, "lineitem")
    assert broadcast_if_small(big, 100) is big


def test_each_message_is_parsed_once(spark):
    from tillwright.operators.parse import parse_events
    from tillwright.sources.ledger import ledger
    from tillwright.sources.topic import to_messages

    silver = C.silver(parse_events(to_messages(ledger(spark, SF_SMALL), ordered=False)), stamp=False)
    assert silver._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_qa_error_list_is_evaluated_once(spark):
    plan = entry.queries()["dq_errors"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("jsonObjectKeys(") == 1


def test_no_python_udf_in_streaming_operators(spark):
    from tillwright.config import scratch_path
    from tillwright.schemas import MESSAGE_SCHEMA
    from tillwright.sources.topic import read_events
    from tillwright.streaming import jobs as S

    topic = scratch_path(spark, "t-plan-topic")
    spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in MESSAGE_SCHEMA.fields]).write.parquet(topic)
    msgs = read_events(spark, topic)
    frames = {
        "bronze": S.bronze_stream(msgs, full=True),
        "silver": S.silver_stream(msgs),
        "live_gold": S.live_gold(S.silver_stream(msgs), G.STORE),
        "live_gold_all": G.gold_all(S.silver_stream(msgs)),
        "dedup": S.dedup_stream(S.typed_stream(msgs)),
    }
    for name, df in frames.items():
        assert df.isStreaming, name
        plan = df._jdf.queryExecution().analyzed().toString()
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, name
