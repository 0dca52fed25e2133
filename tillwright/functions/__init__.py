"""Column expressions shared by the operators (all built-in, JVM-side)."""

from .jsonkeys import missing_keys
from .money import exact, is_finite, line_total, out_of_range, revenue_sum, to_local, to_usd
from .timeparse import parse_event_time

__all__ = [
    "exact",
    "is_finite",
    "line_total",
    "missing_keys",
    "out_of_range",
    "parse_event_time",
    "revenue_sum",
    "to_local",
    "to_usd",
]
