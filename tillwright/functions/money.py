"""Money expressions.

Amounts travel as double; sums are taken in decimals of six places, so the
result does not depend on the order partitions are combined in, then rounded
once to cents and returned as double. An amount no decimal can hold (beyond
1e20, NaN, Infinity) gives null, never an error: rules report it by name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT, USD_AMOUNT

_MAX_DOUBLE = 1.7976931348623157e308


def exact(c: Column | str) -> Column:
    """An amount as an exact decimal of six places (out of range, NaN, Infinity -> null)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(AMOUNT)


def out_of_range(c: Column | str) -> Column:
    """True for an amount that has no exact value here; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), exact(c).isNull())


def revenue_sum(c: Column | str) -> Column:
    """``round(sum(amount), 2)`` as double, summed exactly in decimal."""
    return F.round(F.sum(exact(c)), 2).cast("double")


def line_total(price: Column | str, qty: Column | str) -> Column:
    """``round(price * qty, 2)`` computed in decimal (no binary rounding surprises)."""
    price = F.col(price) if isinstance(price, str) else price
    qty = F.col(qty) if isinstance(qty, str) else qty
    return F.round(exact(price) * qty, 2)


def to_usd(amount: Column | str, rate: Column | str) -> Column:
    """Local amount -> USD, rounded half-up to cents, as a decimal.

    The quotient is exact to 13 places before the final rounding, so no
    amount of cents lands on a rounding boundary by accident.
    """
    rate = F.col(rate) if isinstance(rate, str) else rate
    return (exact(amount) / rate).cast(USD_AMOUNT)


def to_local(usd: Column | str, rate: Column | str) -> Column:
    """USD -> local currency at ``rate`` units per USD, rounded to cents."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    return F.round(exact(usd) * rate, 2)


def is_finite(c: Column | str) -> Column:
    """True for a real number; false for NaN and +/-Infinity; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    # Spark orders NaN above every double, so one comparison of the absolute
    # value excludes NaN and both infinities (and references ``c`` once).
    return F.abs(c) <= F.lit(_MAX_DOUBLE)
