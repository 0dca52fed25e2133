"""Silver cleaning rules, each usable alone, and the rejects they produce.

A row passes a rule only when the predicate is true; null fails (SQL
three-valued logic), as with ``filter(col > 0)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_finite, out_of_range
from ..schemas import PRICE_CAP
from .parse import with_event_time, with_processed_time


def _rules(check_finite: bool) -> list[tuple[str, Column]]:
    rules = [
        ("transaction_id_null", F.col("transaction_id").isNotNull()),
        ("product_name_null", F.col("product_name").isNotNull()),
        ("unit_price_not_positive", F.col("unit_price") > 0),
        ("total_amount_not_positive", F.col("total_amount") > 0),
        ("unit_price_over_cap", F.col("unit_price") < PRICE_CAP),
        ("quantity_not_positive", F.col("quantity") > 0),
    ]
    if check_finite:
        # NaN > 0 is true in Spark, so a NaN total would pass the rules above and
        # poison a double sum; in a decimal sum it would silently vanish.
        rules.append(("total_amount_not_finite", is_finite("total_amount")))
        # A finite amount too large for the exact sums would vanish from them.
        rules.append(("total_amount_out_of_range", ~out_of_range("total_amount")))
    return rules


RULE_NAMES = [
    "transaction_id_null",
    "product_name_null",
    "unit_price_not_positive",
    "total_amount_not_positive",
    "unit_price_over_cap",
    "quantity_not_positive",
    "total_amount_not_finite",
    "total_amount_out_of_range",
]


def rule(name: str) -> Column:
    """The pass predicate of one named rule."""
    return dict(_rules(True))[name]


def filter_rule(df: DataFrame, name: str) -> DataFrame:
    return df.filter(rule(name))


def passes_all(check_finite: bool = True) -> Column:
    preds = [p for _, p in _rules(check_finite)]
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def reject_reason(check_finite: bool = True) -> Column:
    """Name of the first rule a row fails, or null when it passes all."""
    return F.coalesce(
        *[F.when(~F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in _rules(check_finite)]
    )


def clean(df: DataFrame, check_finite: bool = True) -> DataFrame:
    """The composite rule; Catalyst merges it into one pushed-down filter."""
    return df.filter(passes_all(check_finite))


def silver(bronze: DataFrame, check_finite: bool = True, stamp: bool = True) -> DataFrame:
    """Bronze (9 parsed fields) -> silver: typed time, ingest stamp, rules."""
    typed = with_event_time(bronze)
    if stamp:
        typed = with_processed_time(typed)
    return clean(typed, check_finite)


def rejects(bronze: DataFrame, check_finite: bool = True) -> DataFrame:
    """Rows silver drops, each with the first rule it fails (``reject_reason``)."""
    return (
        with_event_time(bronze)
        .withColumn("reject_reason", reject_reason(check_finite))
        .filter(F.col("reject_reason").isNotNull())
    )


def reject_summary(bronze: DataFrame, check_finite: bool = True) -> DataFrame:
    """Rejected rows per reason."""
    return (
        rejects(bronze, check_finite)
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )
