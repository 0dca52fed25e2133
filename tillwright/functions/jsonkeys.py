"""Key presence on raw JSON text (absence, not null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing_keys(raw: Column | str, required: list[str]) -> Column:
    """Required keys absent from a JSON object, in ``required`` order.

    A key present with a null value counts as present. Text that is not a
    JSON object (malformed, an array, a scalar) misses every key.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    wanted = F.array(*[F.lit(k) for k in required])
    present = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    return F.array_except(wanted, present)
