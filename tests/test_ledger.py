"""The pruned ledger needs no orders: no line lacks its order, no order its customer."""

from __future__ import annotations

import pytest

from tillwright.sources.ledger import bronze_rows
from tillwright.sources.tables import table

SIZES = [f"/root/testdata/{d}" for d in ("sf0.001", "sf0.01", "sf0.1")]


@pytest.mark.parametrize("sf_dir", SIZES)
def test_no_orphans(spark, sf_dir):
    lines, orders, customers = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    assert lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left_anti").count() == 0
    assert orders.join(customers, orders.o_custkey == customers.c_custkey, "left_anti").count() == 0


def test_pruned_events_are_the_full_ones(spark):
    full = bronze_rows(spark, SIZES[0], full=True)
    pruned = bronze_rows(spark, SIZES[0])
    assert sorted(map(str, pruned.collect())) == sorted(map(str, full.select(*pruned.columns).collect()))
    assert "orders.parquet" not in pruned._jdf.queryExecution().executedPlan().toString()


def test_a_large_table_is_joined_in_more_tasks(spark, monkeypatch):
    """Beyond the session's partitions, their number follows the lines, with the same rows."""
    from tillwright.sources import ledger as L

    few = L.ledger(spark, SIZES[0])
    monkeypatch.setattr(L, "LINES_PER_TASK", 200)
    many = L.ledger(spark, SIZES[0])
    parts = -(-spark.read.parquet(f"{SIZES[0]}/lineitem.parquet").count() // 200)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(l_orderkey") == 1 and f", {parts})" in plan.split("hashpartitioning(l_orderkey")[1].split("\n")[0]
    assert f", {parts})" in plan.split("hashpartitioning(o_orderkey")[1].split("\n")[0]
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()


def test_large_dimensions_are_joined_in_more_tasks(spark, monkeypatch):
    """Dimensions of too many rows to broadcast are joined in tasks that follow the lines, the orders last, with the same rows."""
    from tillwright.sources import ledger as L

    few = {buyers: L.ledger(spark, SIZES[0], buyers) for buyers in (True, False)}
    monkeypatch.setattr(L, "LINES_PER_TASK", 200)
    monkeypatch.setattr(L, "broadcast_limit", lambda spark: 5)
    n = -(-spark.read.parquet(f"{SIZES[0]}/lineitem.parquet").count() // 200)
    for buyers in (True, False):
        many = L.ledger(spark, SIZES[0], buyers)
        plan = many._jdf.queryExecution().executedPlan().toString()
        for key in ["l_suppkey", "s_suppkey", "l_partkey", "p_partkey", *(["l_orderkey", "o_custkey", "c_custkey"] if buyers else [])]:
            dealt = plan.split(f"hashpartitioning({key}")
            assert len(dealt) == 2 and f", {n})" in dealt[1].split("\n")[0], (buyers, key)
        assert not buyers or plan.index("hashpartitioning(l_orderkey") < plan.index("hashpartitioning(l_partkey")
        assert few[buyers].exceptAll(many).isEmpty() and many.exceptAll(few[buyers]).isEmpty()
