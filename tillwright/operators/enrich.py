"""Dimension lookups as joins, and currency normalisation.

Stores and products are joined with ``broadcast_if_small`` (broadcast only
below a counted row bound, otherwise a shuffle join); so is the FX table a
caller passes in. Unknown currencies fall back to rate 1.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import to_local, to_usd
from ..schemas import FX_DEFAULT_RATE, RATE
from ..sources.tables import broadcast_if_small


def enrich_store(events: DataFrame, stores: DataFrame) -> DataFrame:
    """Add store_name, city, region by ``store_id`` (left join: no row lost)."""
    dim = stores.select("store_id", "store_name", "city", "region")
    return events.join(broadcast_if_small(dim), "store_id", "left")


def enrich_product(events: DataFrame, products: DataFrame) -> DataFrame:
    """Add catalogue name, category and USD base price by ``sku``.

    Joined on ``sku``: product names are not unique, so a name join would
    multiply rows.
    """
    dim = products.select(
        "sku",
        F.col("product_name").alias("catalog_name"),
        F.col("category").alias("catalog_category"),
        "base_price_usd",
    )
    return events.join(broadcast_if_small(dim), "sku", "left")


# A currency table has at most a few hundred rows.
FX_BROADCAST_ROWS = 10_000


def with_rate(events: DataFrame, fx: DataFrame) -> DataFrame:
    """Add ``rate`` (units per USD) by currency; unknown -> 1.0."""
    dim = broadcast_if_small(fx.select("currency", F.col("rate").alias("fx_rate")), FX_BROADCAST_ROWS)
    return (
        events.join(dim, "currency", "left")
        .withColumn("rate", F.coalesce(F.col("fx_rate"), F.lit(FX_DEFAULT_RATE).cast(RATE)))
        .drop("fx_rate")
    )


def local_list_price(events: DataFrame, products: DataFrame, fx: DataFrame) -> DataFrame:
    """Catalogue USD price converted to the sale's local currency."""
    priced = with_rate(enrich_product(events, products), fx)
    return priced.select(
        "transaction_id",
        "sku",
        "currency",
        to_local("base_price_usd", "rate").cast("double").alias("list_price_local"),
    )


def with_usd(events: DataFrame, fx: DataFrame) -> DataFrame:
    """Add ``total_usd``: the sale total in USD, rounded half-up to cents."""
    return with_rate(events, fx).withColumn("total_usd", to_usd("total_amount", "rate"))


def usd_amounts(silver: DataFrame, fx: DataFrame) -> DataFrame:
    return with_usd(silver, fx).select(
        "transaction_id", "currency", "total_amount", F.col("total_usd").cast("double").alias("total_usd")
    )


_USD_KEYS = {"country": ["country"], "store": ["store_id", "country"], "product": ["product_name"]}


def usd_revenue(silver: DataFrame, fx: DataFrame, by: str) -> DataFrame:
    """Revenue normalised to USD, so groups spanning currencies add up."""
    keys = _USD_KEYS[by]
    return (
        with_usd(silver, fx)
        .groupBy(*keys)
        .agg(
            F.round(F.sum("total_usd"), 2).cast("double").alias("total_revenue_usd"),
            F.count("transaction_id").alias("total_transactions"),
        )
    )


def usd_tables(silver: DataFrame, fx: DataFrame) -> DataFrame:
    """Revenue in USD by country, store and product from one scan: rows are
    aggregated by all keys together, GROUPING SETS triple only that result.
    ``usd_table`` says which table a row belongs to; other keys are null."""
    keys = ["country", "store_id", "product_name"]
    rows = with_usd(silver, fx).groupBy(*keys).agg(F.sum("total_usd").alias("_usd"), F.count("transaction_id").alias("_n"))
    grouped = rows.groupingSets([[F.col(k) for k in by] for by in _USD_KEYS.values()], *keys).agg(
        F.round(F.sum("_usd"), 2).cast("double").alias("total_revenue_usd"),
        F.sum("_n").alias("total_transactions"),
        F.grouping_id(*keys).alias("_gid"),
    )
    tag = F.when(F.col("_gid") == 0b011, F.lit("country")).when(F.col("_gid") == 0b001, F.lit("store")).otherwise(F.lit("product"))
    return grouped.select(tag.alias("usd_table"), *keys, "total_revenue_usd", "total_transactions")


def usd_table(tagged: DataFrame, by: str) -> DataFrame:
    """One table cut from :func:`usd_tables`."""
    return tagged.filter(F.col("usd_table") == by).select(*_USD_KEYS[by], "total_revenue_usd", "total_transactions")
