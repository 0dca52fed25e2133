"""Hand-written edge rows for parsing and the silver rules."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest

from tillwright.operators import clean as C
from tillwright.operators.parse import parse_events, with_event_time
from tillwright.schemas import MESSAGE_SCHEMA

BASE = {
    "transaction_id": "t1",
    "event_time": "2026-03-28T08:27:13.123456+00:00",
    "store_id": "R1",
    "product_name": "p",
    "unit_price": 1.5,
    "quantity": 2,
    "total_amount": 3.0,
    "country": "US",
    "currency": "USD",
}


def row(**changes):
    d = dict(BASE)
    for k, v in changes.items():
        if v is _DROP:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


_DROP = object()


def _messages(spark, values):
    return spark.createDataFrame([("R1", v) for v in values], MESSAGE_SCHEMA)


def _parse_one(spark, value, full=False):
    return parse_events(_messages(spark, [value]), full=full).collect()[0]


def _silver_count(spark, value):
    return C.silver(parse_events(_messages(spark, [value])), stamp=False).count()


def test_base_row_parses_and_passes(spark):
    r = _parse_one(spark, row())
    assert r.asDict() == BASE
    assert _silver_count(spark, row()) == 1


def test_z_offset_and_date_only_times(spark):
    vals = [row(event_time="2026-03-28T08:27:13.123456Z"), row(event_time="2026-03-28")]
    got = [r.event_time for r in with_event_time(parse_events(_messages(spark, vals))).collect()]
    assert got == [dt.datetime(2026, 3, 28, 8, 27, 13, 123456), dt.datetime(2026, 3, 28)]


def test_offset_is_honoured_as_utc(spark):
    got = with_event_time(parse_events(_messages(spark, [row(event_time="2026-03-28T10:00:00+02:00")])))
    assert got.collect()[0].event_time == dt.datetime(2026, 3, 28, 8, 0, 0)


def test_unknown_key_ignored(spark):
    assert _parse_one(spark, row(extra="x")).asDict() == BASE


@pytest.mark.parametrize("text", ["not json", row()[:-5], "[1, 2]", "null"])
def test_malformed_gives_all_nulls_and_fails_silver(spark, text):
    r = _parse_one(spark, text)
    assert all(v is None for v in r.asDict().values())
    assert _silver_count(spark, text) == 0


@pytest.mark.parametrize("q", ["2.0", '"2"', "3000000000"])
def test_bad_quantity_type_nulls_only_that_field(spark, q):
    text = row().replace('"quantity": 2', f'"quantity": {q}')
    r = _parse_one(spark, text)
    assert r.quantity is None and r.transaction_id == "t1"
    assert _silver_count(spark, text) == 0


def test_numeric_id_becomes_text(spark):
    text = row().replace('"transaction_id": "t1"', '"transaction_id": 5')
    assert _parse_one(spark, text).transaction_id == "5"


def test_non_finite_total_is_rejected_by_the_finite_rule_only(spark):
    for token in ("NaN", "Infinity"):
        text = row().replace('"total_amount": 3.0', f'"total_amount": {token}')
        parsed = _parse_one(spark, text)
        assert math.isnan(parsed.total_amount) or math.isinf(parsed.total_amount)
        # the six reference rules let it through (NaN > 0 is true in Spark) ...
        kept = C.silver(parse_events(_messages(spark, [text])), check_finite=False, stamp=False)
        assert kept.count() == 1
        # ... our switchable seventh rule reports and removes it.
        rej = C.rejects(parse_events(_messages(spark, [text]))).collect()
        assert [r.reject_reason for r in rej] == ["total_amount_not_finite"]


def test_nan_price_fails_at_the_cap(spark):
    text = row().replace('"unit_price": 1.5', '"unit_price": NaN')
    rej = C.rejects(parse_events(_messages(spark, [text]))).collect()
    assert [r.reject_reason for r in rej] == ["unit_price_over_cap"]


@pytest.mark.parametrize("country", [None, ""])
def test_null_or_empty_country_passes(spark, country):
    assert _silver_count(spark, row(country=country)) == 1


@pytest.mark.parametrize("bad", ["bad", "", "2026-13-01T00:00:00+00:00"])
def test_bad_time_is_null_not_an_error(spark, bad):
    df = C.silver(parse_events(_messages(spark, [row(event_time=bad)])), stamp=False)
    got = df.collect()
    assert len(got) == 1 and got[0].event_time is None


def test_first_failing_rule_is_reported(spark):
    vals = [
        row(transaction_id=_DROP, unit_price=-1.0),
        row(product_name=None),
        row(unit_price=-2.0),
        row(total_amount=0.0),
        row(unit_price=10_000_000.0),
        row(quantity=0),
    ]
    got = sorted(r.reject_reason for r in C.rejects(parse_events(_messages(spark, vals))).collect())
    assert got == sorted(
        [
            "transaction_id_null",
            "product_name_null",
            "unit_price_not_positive",
            "total_amount_not_positive",
            "unit_price_over_cap",
            "quantity_not_positive",
        ]
    )


def test_full_mode_keeps_every_field_and_raw_text(spark):
    full = dict(BASE, sku="S", is_fraud_flag=True, producer_version="1.0.0")
    text = json.dumps(full)
    r = parse_events(_messages(spark, [text]), full=True, keep_raw=True).collect()[0]
    assert r.value == text and r.sku == "S" and r.is_fraud_flag is True
