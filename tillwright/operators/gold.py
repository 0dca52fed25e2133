"""Gold aggregates over silver.

Each gold table is one partial + final hash aggregation. ``gold_all``
computes all three in a single scan of silver: rows are first aggregated by
all keys together, and GROUPING SETS then triple only that small result; the
three tables are cut from it. Money is summed exactly and rounded at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact, revenue_sum

COUNTRY = "revenue_by_country"
PRODUCTS = "top_products"
STORE = "revenue_by_store"
GOLD_TABLES = (COUNTRY, PRODUCTS, STORE)

KEYS = {
    COUNTRY: ["country", "currency"],
    PRODUCTS: ["product_name"],
    STORE: ["store_id", "country"],
}
# All keys together, and the type of an unrounded sum.
PARTIAL_KEYS = ["country", "currency", "product_name", "store_id"]
PARTIAL_REVENUE = "decimal(38,6)"
# Registers of a distinct-count sketch (log 2): relative standard error 0.0081, three of them 2.5 %.
SKETCH_LG = 14
SKETCH_ERROR = 0.025
# Gold column order per table (measure order as written by the batch job).
_COLUMNS = {
    COUNTRY: ["country", "currency", "total_revenue", "total_transactions"],
    PRODUCTS: ["product_name", "total_transactions", "total_revenue"],
    STORE: ["store_id", "country", "total_revenue", "total_transactions"],
}
# Sort as written: measure desc, then the keys ascending as a tie-break.
_SORT_MEASURE = {COUNTRY: "total_transactions", PRODUCTS: "total_transactions", STORE: "total_revenue"}


def _measures():
    return [
        revenue_sum("total_amount").alias("total_revenue"),
        F.count("transaction_id").alias("total_transactions"),
    ]


def sort_gold(df: DataFrame, name: str, measure: str | None = None, within_partitions: bool = False) -> DataFrame:
    m = measure or _SORT_MEASURE[name]
    order = [F.col(m).desc(), *[F.col(k).asc_nulls_last() for k in KEYS[name]]]
    return df.sortWithinPartitions(*order) if within_partitions else df.orderBy(*order)


def gold_table(silver: DataFrame, name: str, sort: bool = True) -> DataFrame:
    out = silver.groupBy(*KEYS[name]).agg(*_measures()).select(*_COLUMNS[name])
    return sort_gold(out, name) if sort else out


def revenue_by_country(silver: DataFrame, sort: bool = True) -> DataFrame:
    return gold_table(silver, COUNTRY, sort)


def top_products(silver: DataFrame, sort: bool = True) -> DataFrame:
    return gold_table(silver, PRODUCTS, sort)


def revenue_by_store(silver: DataFrame, sort: bool = True) -> DataFrame:
    return gold_table(silver, STORE, sort)


def gold_all(silver: DataFrame) -> DataFrame:
    """All three gold tables from one scan, tagged by ``gold_table``.

    A stream holds one aggregation only, so there GROUPING SETS see the rows.

    Columns: gold_table, country, currency, product_name, store_id,
    total_revenue, total_transactions. Keys a table does not group by are null.
    """
    if silver.isStreaming:
        return _grouped(silver, F.sum(exact("total_amount")), F.count("transaction_id"))
    return gold_of_partials(partials(silver))


def partials(silver: DataFrame) -> DataFrame:
    """Unrounded sums by all keys together, from which every gold table follows: PARTIAL_KEYS, revenue, transactions."""
    revenue = F.sum(exact("total_amount")).cast(PARTIAL_REVENUE).alias("revenue")
    return silver.groupBy(*PARTIAL_KEYS).agg(revenue, F.count("transaction_id").alias("transactions"))


def merged_partials(rows: DataFrame) -> DataFrame:
    """Partial sums of several sets of rows, added up by key."""
    return rows.groupBy(*PARTIAL_KEYS).agg(F.sum("revenue").cast(PARTIAL_REVENUE).alias("revenue"), F.sum("transactions").alias("transactions"))


def gold_of_partials(rows: DataFrame) -> DataFrame:
    """The tagged gold tables from partial sums."""
    return _grouped(rows, F.sum("revenue"), F.sum("transactions"))


def _grouped(rows: DataFrame, revenue: Column, transactions: Column) -> DataFrame:
    keys = PARTIAL_KEYS
    grouped = rows.groupingSets(
        [KEYS[COUNTRY], KEYS[PRODUCTS], KEYS[STORE]],
        *keys,
    ).agg(
        revenue.alias("revenue_exact"),
        transactions.alias("total_transactions"),
        F.grouping_id(*keys).alias("gid"),
    )
    # grouping_id bit order follows the argument order (country is the high bit).
    tag = (
        F.when(F.col("gid") == 0b0011, F.lit(COUNTRY))
        .when(F.col("gid") == 0b1101, F.lit(PRODUCTS))
        .when(F.col("gid") == 0b0110, F.lit(STORE))
    )
    return grouped.select(
        tag.alias("gold_table"),
        "country",
        "currency",
        "product_name",
        "store_id",
        F.round("revenue_exact", 2).cast("double").alias("total_revenue"),
        "total_transactions",
    )


def distinct_sketches(silver: DataFrame, by: list[str], column: str) -> DataFrame:
    """One HyperLogLog sketch (``sketch``) of the distinct values of ``column`` per group: kilobytes, whatever the group holds."""
    return silver.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(SKETCH_LG)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of several versions, files or finer groups, merged by coarser keys."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch", F.lit(False)).alias("sketch"))


def sketch_estimate(name: str) -> Column:
    return F.hll_sketch_estimate("sketch").alias(name)


def sort_tagged(tagged: DataFrame) -> DataFrame:
    """Tagged gold in one order that sorts every table as written."""
    by_revenue = F.when(F.col("gold_table") == STORE, F.col("total_revenue"))
    measure = F.coalesce(by_revenue, F.col("total_transactions").cast("double"))
    keys = ["product_name", "store_id", "country", "currency"]
    return tagged.orderBy("gold_table", measure.desc(), *[F.col(k).asc_nulls_last() for k in keys])


def split_gold(tagged: DataFrame, name: str, sort: bool = True) -> DataFrame:
    """One gold table cut from ``gold_all`` output (or its stored copy)."""
    out = tagged.filter(F.col("gold_table") == name).select(*_COLUMNS[name])
    return sort_gold(out, name) if sort else out


def tagged_table(df: DataFrame, name: str) -> DataFrame:
    """One gold table in the tagged shape of ``gold_all``."""
    cols = ["country", "currency", "product_name", "store_id", "total_revenue", "total_transactions"]
    have = [(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in cols]
    return df.select(F.lit(name).alias("gold_table"), *have)


def tagged_gold(tables: dict[str, DataFrame]) -> DataFrame:
    """Three separate gold tables -> the tagged shape of ``gold_all``."""
    out = tagged_table(tables[GOLD_TABLES[0]], GOLD_TABLES[0])
    for name in GOLD_TABLES[1:]:
        out = out.unionByName(tagged_table(tables[name], name))
    return out


def row_count(silver: DataFrame) -> DataFrame:
    """Silver row count as a one-row frame (``n_rows``)."""
    return silver.agg(F.count(F.lit(1)).alias("n_rows"))
