"""Reading the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Rows a dimension may hold and still be broadcast. A broadcast copy lands on
# every executor, so the bound is on rows actually counted, not on estimates.
DEFAULT_BROADCAST_ROWS = 200_000


# Declared schemas of the tables the sales ledger reads: a declared schema
# skips the footer-reading job that inference costs on every read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters to the scan."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parts_for(rows: int, rows_per_part: int) -> int:
    """Parts of at most about ``rows_per_part`` rows, one at least."""
    return max(1, -(-rows // rows_per_part))


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a driver table, from the file footers."""
    return table(spark, sf_dir, name).count()


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("tillwright.broadcast.maxRows", str(DEFAULT_BROADCAST_ROWS)))


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only when the side is proven to hold <= ``max_rows``.

    ``limit(n + 1).count()`` stops reading once the bound is exceeded, so the
    check costs at most ``n + 1`` rows. Beyond the bound the side is left to
    the shuffle join Spark plans (and AQE may still demote it at run time).
    """
    bound = broadcast_limit(df.sparkSession) if max_rows is None else max_rows
    if df.limit(bound + 1).count() <= bound:
        return F.broadcast(df)
    return df
