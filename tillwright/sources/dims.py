"""Store, product and FX dimensions.

The producer keeps these as Python lists; here they are tables. Stores and
products derive from the driver tables (supplier/nation/region and part);
FX rates are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FX_RATES, MONEY, RATE
from .tables import table


def store_code(key: Column) -> Column:
    """``R`` + the key padded to at least four digits (never truncated)."""
    text = key.cast("string")
    return F.concat(F.lit("R"), F.when(key < 10000, F.lpad(text, 4, "0")).otherwise(text))


def fx_dim(spark: SparkSession) -> DataFrame:
    """currency, rate (units per USD), fx_id (position, used to assign nations)."""
    values = ", ".join(
        f"({i}, '{cur}', CAST('{rate}' AS {RATE.simpleString()}))" for i, (cur, rate) in enumerate(FX_RATES)
    )
    # A literal relation built in the JVM (no Python worker reads it).
    return spark.sql(f"SELECT * FROM VALUES {values} AS fx(fx_id, currency, rate)")


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation + region + currency: one row per nation (25 under TPC-H)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    fx = F.broadcast(fx_dim(spark))  # 9 literal rows
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .join(fx, (F.col("n_nationkey") % F.lit(len(FX_RATES))) == fx.fx_id)
        .select("n_nationkey", "n_name", "r_name", "currency", "rate")
    )


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per store (supplier): ids, names, location, currency and rate."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = nation_dim(spark, sf_dir)
    return supplier.join(nations, supplier.s_nationkey == nations.n_nationkey).select(
        "s_suppkey",
        store_code(F.col("s_suppkey")).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.concat(F.lit("City-"), F.col("s_nationkey").cast("string")).alias("city"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        "currency",
        "rate",
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per product (part), keyed by ``sku``; names are not unique."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("base_price_usd"),
    )
