"""Compute a costly column once per row.

Catalyst substitutes a projected expression into every filter and projection
that uses it. For cheap expressions that is right; for a JSON parse or a list
of checks it repeats the work per use. Producing the column through a
one-element ``inline`` (a Generate node) keeps it a plain column above that
point, so it is evaluated exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``df.withColumn(name, expr)``, evaluated once per row whatever uses it."""
    return df.select("*", F.inline(F.array(F.struct(expr.alias(name)))))
