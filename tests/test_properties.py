"""Property checks against brute-force Python on generated rows."""

from __future__ import annotations

import datetime as dt
import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwright.operators import clean as C
from tillwright.operators import enrich as E
from tillwright.schemas import FX_RATES, PRICE_CAP
from tillwright.sources.dims import fx_dim

_money = st.one_of(
    st.none(),
    st.sampled_from([0.0, -0.0, 0.01, -1.0, float(PRICE_CAP), PRICE_CAP - 0.01, float("nan"), float("inf"), float("-inf")]),
    st.floats(min_value=-1e8, max_value=1e8, allow_nan=False).map(lambda x: round(x, 2)),
)
_row = st.tuples(
    st.one_of(st.none(), st.text(min_size=1, max_size=4)),
    st.one_of(st.none(), st.sampled_from(["p", "q"])),
    _money,
    st.one_of(st.none(), st.integers(min_value=-3, max_value=5)),
    _money,
)


def _python_reason(tid, name, price, qty, total):
    """The silver rules as plain Python (SQL: a null comparison fails)."""
    checks = [
        ("transaction_id_null", tid is not None),
        ("product_name_null", name is not None),
        ("unit_price_not_positive", price is not None and _cmp(price, 0) > 0),
        ("total_amount_not_positive", total is not None and _cmp(total, 0) > 0),
        ("unit_price_over_cap", price is not None and _cmp(price, PRICE_CAP) < 0),
        ("quantity_not_positive", qty is not None and qty > 0),
        ("total_amount_not_finite", total is not None and math.isfinite(total)),
    ]
    return next((n for n, ok in checks if not ok), None)


def _cmp(a: float, b: float) -> int:
    """Spark's double ordering: NaN above everything, -0.0 == 0.0."""
    if math.isnan(a):
        return 0 if isinstance(b, float) and math.isnan(b) else 1
    return (a > b) - (a < b)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(_row, min_size=1, max_size=40))
def test_first_failing_rule_matches_python(spark, rows):
    schema = "transaction_id string, product_name string, unit_price double, quantity int, total_amount double"
    df = spark.createDataFrame(rows, schema).withColumn("_i", F.monotonically_increasing_id())
    got = {r["_i"]: r["reason"] for r in df.select("_i", C.reject_reason().alias("reason")).collect()}
    ids = [r["_i"] for r in df.select("_i").collect()]
    expected = {i: _python_reason(*row) for i, row in zip(ids, rows)}
    assert got == expected
    kept = C.clean(df).count()
    assert kept == sum(1 for v in expected.values() if v is None)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(
            st.integers(min_value=1, max_value=10**11),
            st.sampled_from([c for c, _ in FX_RATES] + ["XXX"]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_usd_conversion_is_exact_half_up(spark, rows):
    rates = {c: Decimal(r) for c, r in FX_RATES}
    data = [(f"t{i}", cur, cents / 100.0) for i, (cents, cur) in enumerate(rows)]
    df = spark.createDataFrame(data, "transaction_id string, currency string, total_amount double")
    got = {r.transaction_id: r.total_usd for r in E.usd_amounts(df, fx_dim(spark)).collect()}
    for (tid, cur, amount), (cents, _) in zip(data, rows):
        exact = (Decimal(cents) / 100 / rates.get(cur, Decimal("1.0"))).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got[tid] == float(exact), (tid, cur, amount)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    stamps=st.lists(
        st.tuples(
            st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2099, 12, 31)),
            st.integers(min_value=-48, max_value=56),  # offset in quarter hours
        ),
        min_size=1,
        max_size=30,
    )
)
def test_event_time_parsing_is_utc_and_zone_independent(spark, stamps):
    from tillwright.functions import parse_event_time

    texts = [
        local.replace(tzinfo=dt.timezone(dt.timedelta(minutes=15 * q))).isoformat() for local, q in stamps
    ]
    expected = [
        local.replace(tzinfo=dt.timezone(dt.timedelta(minutes=15 * q))).astimezone(dt.timezone.utc).replace(tzinfo=None)
        for local, q in stamps
    ]
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")  # a zone with daylight saving
    try:
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = {r.i: r.ts for r in df.select("i", parse_event_time("t").alias("ts")).collect()}
    finally:
        spark.conf.set(key, before)
    assert [got[i] for i in range(len(texts))] == expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["t1", "t2", "t3"])),
            st.one_of(st.none(), st.sampled_from(["R1", "R2"])),
            st.sampled_from(["p", "q"]),
            st.integers(min_value=1, max_value=10**7).map(lambda c: c / 100.0),
            st.one_of(st.none(), st.sampled_from(["US", "JP"])),
            st.one_of(st.none(), st.sampled_from(["USD", "JPY"])),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_one_scan_gold_equals_separate_aggregations_with_null_keys(spark, rows):
    from tillwright.operators import gold as G

    schema = "transaction_id string, store_id string, product_name string, total_amount double, country string, currency string"
    silver = spark.createDataFrame(rows, schema)
    tagged = G.gold_all(silver)
    for name in G.GOLD_TABLES:
        one = sorted(map(tuple, G.split_gold(tagged, name, sort=False).collect()), key=repr)
        sep = sorted(map(tuple, G.gold_table(silver, name, sort=False).collect()), key=repr)
        assert one == sep, name
