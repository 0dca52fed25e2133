"""Reports and KPIs over gold tables.

Sorted reports keep an explicit tie-break (measure desc, then keys asc) so
top-k and arg-max answers are stable. KPIs are aggregations without a
grouping key, so they always return exactly one row (nulls when gold is empty).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gold import COUNTRY, PRODUCTS, STORE, tagged_gold


def _rounded():
    return F.round("total_revenue", 2).alias("total_revenue")


def report_revenue_by_country(country: DataFrame) -> DataFrame:
    return country.select("country", "currency", "total_transactions", _rounded()).orderBy(
        F.col("total_transactions").desc(), F.col("country").asc_nulls_last(), F.col("currency").asc_nulls_last()
    )


def report_top_products(products: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` products by transactions (TakeOrderedAndProject: no full sort)."""
    return (
        products.select("product_name", "total_transactions", _rounded())
        .orderBy(F.col("total_transactions").desc(), F.col("product_name").asc_nulls_last())
        .limit(k)
    )


def report_top_stores(store: DataFrame) -> DataFrame:
    """Stores by transactions (the warehouse report's order, not gold's)."""
    return store.select("store_id", "country", "total_transactions", _rounded()).orderBy(
        F.col("total_transactions").desc(), F.col("store_id").asc_nulls_last(), F.col("country").asc_nulls_last()
    )


def _argmax_by_transactions(key: str):
    """Key with the most transactions; ties go to the smallest key."""
    return F.min_by(F.col(key), F.struct((-F.col("total_transactions")).alias("neg"), F.col(key).alias("k")))


def kpi_total_transactions(country: DataFrame) -> DataFrame:
    return country.agg(F.sum("total_transactions").alias("total_transactions"))


def kpi_total_countries(country: DataFrame) -> DataFrame:
    return country.agg(F.count_distinct("country").alias("total_countries"))


def kpi_country_groups(country: DataFrame) -> DataFrame:
    return country.agg(F.count(F.lit(1)).alias("country_groups"))


def kpi_best_product(products: DataFrame) -> DataFrame:
    return products.agg(_argmax_by_transactions("product_name").alias("best_product"))


def kpi_busiest_store(store: DataFrame) -> DataFrame:
    return store.agg(_argmax_by_transactions("store_id").alias("busiest_store"))


def kpi_row(tagged: DataFrame) -> DataFrame:
    """The dashboard's KPI cards in one aggregation over tagged gold."""
    t = F.col("gold_table")
    neg = -F.col("total_transactions")

    def only(name, c):
        return F.when(t == F.lit(name), c)

    return tagged.agg(
        F.sum(only(COUNTRY, F.col("total_transactions"))).alias("total_transactions"),
        F.count_distinct(only(COUNTRY, F.col("country"))).alias("total_countries"),
        F.count(only(COUNTRY, F.lit(1))).alias("country_groups"),
        F.min_by(
            only(PRODUCTS, F.col("product_name")),
            only(PRODUCTS, F.struct(neg.alias("neg"), F.col("product_name").alias("k"))),
        ).alias("best_product"),
        F.min_by(
            only(STORE, F.col("store_id")),
            only(STORE, F.struct(neg.alias("neg"), F.col("store_id").alias("k"))),
        ).alias("busiest_store"),
    )


def dashboard_frames(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Everything the dashboard shows, from the three gold tables.

    KPI cards, country bars, top-10 product bars, store bars (with country)
    and the three raw tables, each ordered by transactions as the dashboard
    reads them. Only these aggregated frames ever reach a client.
    """
    by_tx = F.col("total_transactions").desc()
    return {
        "kpis": kpi_row(tagged_gold(tables)),
        "country_bars": report_revenue_by_country(tables[COUNTRY]),
        "top_products_bars": report_top_products(tables[PRODUCTS], 10),
        "store_bars": report_top_stores(tables[STORE]),
        "raw_revenue_by_country": tables[COUNTRY].orderBy(by_tx, F.col("country").asc_nulls_last(), F.col("currency").asc_nulls_last()),
        "raw_top_products": tables[PRODUCTS].orderBy(by_tx, F.col("product_name").asc_nulls_last()),
        "raw_revenue_by_store": tables[STORE].orderBy(by_tx, F.col("store_id").asc_nulls_last(), F.col("country").asc_nulls_last()),
    }
