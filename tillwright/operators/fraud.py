"""Fraud classification of sales, scored against the producer's ground truth.

A normal price is ``base * rate * [0.98, 1.02]``; a spike multiplies a
normal price by ``[8, 20]``, so any price at or above ``8 * 0.98 * base *
rate`` is a spike. Negative and near-zero (below 1) prices need no catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact, out_of_range
from ..schemas import NEAR_ZERO_LIMIT, NORMAL_BAND_LOW, SPIKE_FACTOR_LOW
from .enrich import enrich_product, with_rate

# Highest ratio of price to list price that the threshold curve tells apart.
MAX_CUT = 100
FRAUD_TYPES = ("negative", "near_zero", "spike")


def spike_threshold() -> F.Column:
    factor = F.lit(SPIKE_FACTOR_LOW) * F.lit(NORMAL_BAND_LOW).cast("decimal(4,2)")
    return F.col("base_price_usd") * F.col("rate") * factor


def classify(events: DataFrame, products: DataFrame, fx: DataFrame) -> DataFrame:
    """Per sale: ``fraud_type`` (negative / near_zero / spike / normal / unknown)
    and ``detected``, beside the ground-truth ``is_fraud_flag``."""
    p = F.col("unit_price")
    kind = (
        F.when(p.isNull(), F.lit("unknown"))
        .when(p < 0, F.lit("negative"))
        .when(p < NEAR_ZERO_LIMIT, F.lit("near_zero"))
        .when(F.col("base_price_usd").isNull(), F.lit("unknown"))
        .when(F.isnan(p), F.lit("unknown"))
        .when(out_of_range(p) | (exact(p) >= spike_threshold()), F.lit("spike"))
        .otherwise(F.lit("normal"))
    )
    enriched = with_rate(enrich_product(events, products), fx)
    return enriched.select(
        "transaction_id",
        "sku",
        "currency",
        "unit_price",
        kind.alias("fraud_type"),
        kind.isin(*FRAUD_TYPES).alias("detected"),
        "is_fraud_flag",
    )


def curve(events: DataFrame, products: DataFrame, fx: DataFrame) -> DataFrame:
    """Precision and recall at every spike threshold, from one histogram.

    A row per hundredth of price over list price that occurs, and one for the
    threshold in use: if prices from ``cut`` times the list price on count as spikes
    (negative and near-zero ones always do), tp, fp, fn, tn, precision and recall.
    Ratios above ``MAX_CUT`` count as ``MAX_CUT``, so the histogram has a bounded
    number of bins and its suffix sums one small window.
    """
    p = F.col("unit_price")
    enriched = with_rate(enrich_product(events, products), fx)
    listed = (F.col("base_price_usd") * F.col("rate")).cast("decimal(26,6)")
    ratio = F.call_function("div", exact(p) * 100, F.when(listed > 0, listed))
    top = F.lit(int(MAX_CUT * 100)).cast("bigint")
    step = (
        F.when(p < NEAR_ZERO_LIMIT, top + 1)  # negative and near-zero: beyond every cut
        .when(p.isNull() | F.col("base_price_usd").isNull() | F.isnan(p), F.lit(-1).cast("bigint"))
        .when(out_of_range(p), top)
        .otherwise(F.least(ratio, top))
    )
    truth = F.coalesce(F.col("is_fraud_flag"), F.lit(False))
    bins = enriched.select(F.coalesce(step, F.lit(-1).cast("bigint")).alias("bin"), truth.alias("truth"))
    bins = bins.groupBy("bin").agg(F.count_if("truth").alias("actual"), F.count_if(~F.col("truth")).alias("other"))
    in_use = F.lit(SPIKE_FACTOR_LOW) * F.lit(NORMAL_BAND_LOW).cast("decimal(4,2)") * 100
    grid = events.sparkSession.range(1).select(in_use.cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("actual"), F.lit(0).cast("bigint").alias("other"))
    bins = bins.unionByName(grid).groupBy("bin").agg(F.sum("actual").alias("actual"), F.sum("other").alias("other"))
    above = Window.orderBy(F.col("bin").desc())  # at most MAX_CUT * 100 + 3 rows
    whole = above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = bins.select(
        "bin",
        F.sum("actual").over(above).alias("tp"),
        F.sum("other").over(above).alias("fp"),
        F.sum("actual").over(whole).alias("all_actual"),
        F.sum("other").over(whole).alias("all_other"),
    )
    tp, flagged = F.col("tp").cast("double"), F.col("tp") + F.col("fp")
    return sums.filter((F.col("bin") >= 0) & (F.col("bin") <= top)).select(
        (F.col("bin").cast("double") / 100).alias("cut"),
        "tp",
        "fp",
        (F.col("all_actual") - F.col("tp")).alias("fn"),
        (F.col("all_other") - F.col("fp")).alias("tn"),
        F.when(flagged > 0, tp / flagged).alias("precision"),
        F.when(F.col("all_actual") > 0, tp / F.col("all_actual")).alias("recall"),
    )


def confusion(classified: DataFrame) -> DataFrame:
    """Counts per (ground truth, detected) cell."""
    return classified.groupBy("is_fraud_flag", "detected").agg(F.count(F.lit(1)).alias("n"))


def scores(classified: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, tn, precision, recall (null when undefined)."""
    truth = F.coalesce(F.col("is_fraud_flag"), F.lit(False))
    det = F.col("detected")
    agg = classified.agg(
        F.count_if(truth & det).alias("tp"),
        F.count_if(~truth & det).alias("fp"),
        F.count_if(truth & ~det).alias("fn"),
        F.count_if(~truth & ~det).alias("tn"),
    )

    tp = F.col("tp").cast("double")
    flagged, actual = F.col("tp") + F.col("fp"), F.col("tp") + F.col("fn")
    return agg.select(
        "tp",
        "fp",
        "fn",
        "tn",
        F.when(flagged > 0, tp / flagged).alias("precision"),
        F.when(actual > 0, tp / actual).alias("recall"),
    )
