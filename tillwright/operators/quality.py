"""Per-row data-quality checks (the QA script's rules as a table job).

Input: fully parsed events (18 fields) plus the raw JSON ``value`` for key
presence. Each rule yields an error code; ``with_errors`` collects all codes
of a row in rule order. Unlike a per-row script, a missing price or quantity
does not abort the run: comparisons with null simply raise no error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact, line_total, missing_keys, out_of_range
from ..functions.once import computed_once
from ..schemas import EVENT_FIELDS, EVENT_SCHEMA, NEAR_ZERO_LIMIT, QA_SPIKE_THRESHOLD, REQUIRED_KEYS
from .parse import message_text

MISSING_PREFIX = "missing_field:"


def missing_fields(raw: str = "value") -> Column:
    """Required keys absent from the text. A parsed value proves its key is
    there, so the text is searched only where some required field is null."""
    some_null = F.lit(False)
    for key in REQUIRED_KEYS:
        some_null = some_null | F.col(key).isNull()
    return F.when(some_null, missing_keys(raw, REQUIRED_KEYS)).otherwise(F.array().cast("array<string>"))


def zero_price() -> Column:
    return F.col("unit_price") == 0


def bad_quantity() -> Column:
    """Quantity <= 0, where an absent (or null) quantity counts as 0."""
    return F.coalesce(F.col("quantity"), F.lit(0)) <= 0


def expected_total() -> Column:
    return line_total("unit_price", "quantity")


def total_mismatch() -> Column:
    """Total differs from round(price * qty, 2), compared exactly in decimal."""
    return exact("total_amount") != expected_total()


def amount_out_of_range() -> Column:
    """A price or total that is no number, infinite, or too large to be summed exactly."""
    return F.coalesce(out_of_range("unit_price"), F.lit(False)) | F.coalesce(out_of_range("total_amount"), F.lit(False))


def fraud_pattern_mismatch() -> Column:
    """A flagged row whose price is neither near-zero, negative nor a spike."""
    p = F.col("unit_price")
    pattern = ((p > 0) & (p < NEAR_ZERO_LIMIT)) | (p < 0) | (p > QA_SPIKE_THRESHOLD)
    return F.col("is_fraud_flag") & ~pattern


def errors(raw: str = "value") -> Column:
    """All error codes of a row, in rule order (empty array when clean)."""
    missing = F.transform(missing_fields(raw), lambda k: F.concat(F.lit(MISSING_PREFIX), k))
    checks = F.array_compact(
        F.array(
            F.when(zero_price(), F.lit("zero_price")),
            F.when(bad_quantity(), F.lit("bad_quantity")),
            F.when(total_mismatch(), F.lit("total_mismatch")),
            F.when(fraud_pattern_mismatch(), F.lit("fraud_pattern_mismatch")),
            F.when(amount_out_of_range(), F.lit("amount_out_of_range")),
        )
    )
    return F.concat(missing, checks)


def with_errors(events: DataFrame, raw: str = "value") -> DataFrame:
    """Add ``errors``, evaluated once per row even when filtered on and output."""
    return computed_once(events, "errors", errors(raw))


def missing_field_rows(events: DataFrame, raw: str = "value") -> DataFrame:
    m = computed_once(events, "_missing", missing_fields(raw))
    return m.filter(F.size("_missing") > 0).select(
        "transaction_id", F.concat_ws(",", "_missing").alias("missing_fields")
    )


def zero_price_rows(events: DataFrame) -> DataFrame:
    return events.filter(zero_price()).select("transaction_id", "unit_price")


def bad_quantity_rows(events: DataFrame) -> DataFrame:
    return events.filter(bad_quantity()).select("transaction_id", "quantity")


def total_mismatch_rows(events: DataFrame) -> DataFrame:
    return events.filter(total_mismatch()).select(
        "transaction_id",
        "unit_price",
        "quantity",
        "total_amount",
        expected_total().cast("double").alias("expected_total"),
    )


def fraud_sanity_rows(events: DataFrame) -> DataFrame:
    return events.filter(fraud_pattern_mismatch()).select("transaction_id", "unit_price")


def error_rows(events: DataFrame, raw: str = "value") -> DataFrame:
    """Rows with at least one error; codes joined with ';' in rule order."""
    e = with_errors(events, raw)
    return e.filter(F.size("errors") > 0).select(
        "transaction_id",
        F.size("errors").alias("n_errors"),
        F.concat_ws(";", "errors").alias("errors"),
    )


def fails_any(raw: str = "value") -> Column:
    """True when ``errors`` would be non-empty, without building the list."""
    checks = [zero_price(), bad_quantity(), total_mismatch(), fraud_pattern_mismatch(), amount_out_of_range()]
    out = F.size(missing_fields(raw)) > 0
    for c in checks:
        out = out | F.coalesce(c, F.lit(False))
    return out


def unparsed_fields(messages: DataFrame) -> DataFrame:
    """Events with fields that are there but have a wrong type, which the typed
    parse makes null: ``transaction_id`` and the names, in producer order.

    The text is parsed once to typed fields and, if one of them is null, once
    to a Variant; a field counts if the Variant has a value that is not null
    and the typed field is null, so only null fields are looked up in the
    Variant. Text that is no JSON object has no fields.
    """
    typed = message_text(messages).select("value", F.inline(F.array(F.struct(F.from_json("value", EVENT_SCHEMA).alias("typed")))))
    some_null = F.lit(False)
    for n, _ in EVENT_FIELDS:
        some_null = some_null | F.col(f"typed.{n}").isNull()
    both = computed_once(typed.filter(some_null), "raw", F.try_parse_json("value")).drop("value")

    def wrong(name: str) -> Column:
        raw = F.try_variant_get("raw", f"$.{name}", "variant")
        return F.col(f"typed.{name}").isNull() & raw.isNotNull() & ~F.is_variant_null(raw)

    names = F.array_compact(F.array(*[F.when(wrong(n), F.lit(n)) for n, _ in EVENT_FIELDS]))
    found = both.select(F.col("typed.transaction_id").alias("transaction_id"), F.inline(F.array(F.struct(names.alias("names")))))
    return found.filter(F.size("names") > 0).select("transaction_id", F.array_join("names", ",").alias("unparsed_fields"))


def summary(events: DataFrame, raw: str = "value") -> DataFrame:
    """One row: rows checked, passed, failed, and flagged as fraud."""
    e = computed_once(events, "_failed", fails_any(raw))
    failed = F.col("_failed")
    return e.agg(
        F.count(F.lit(1)).alias("n_checked"),
        F.count_if(~failed).alias("n_passed"),
        F.count_if(failed).alias("n_failed"),
        F.count_if(F.coalesce(F.col("is_fraud_flag"), F.lit(False))).alias("n_fraud"),
    )
