"""The driver tables in sales-event shape (the "ledger").

One row per ``lineitem``: the sale of a part by a supplier's store. Faults
are a pure function of the line's keys, so every engine sees the same dirty
rows. The fault code ``h`` (0-99) selects:

    0 negative price (flagged)   1 price 0.50 (flagged)   2 price x 12 (flagged)
    3 quantity 0                 4 null product_name      5 null transaction_id
    6 total off by +1            7 price at the 10,000,000 cap (not flagged)
    8 price 0                    9 price 100.00 (flagged)  10 unknown currency
    11 unknown sku               12 infinite total

Join plan: every dimension table joins the fact stream directly. Parts,
suppliers and customers are broadcast while their own rows are few, else joined
by a shuffled hash join (:func:`_with_dimension`); ``orders`` (as
big as the facts divided by ~4) is joined on ``o_orderkey`` by a shuffle join,
only where an event's order columns are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_FIELDS, FX_RATES, MONEY, PARSED_FIELDS, PRICE_CAP
from .dims import fx_dim, store_code
from .tables import broadcast_limit, parts_for, row_count, table

# Lines that one task of a shuffle join holds: what the orders join and a sort after it need is 1.3 KB a line.
LINES_PER_TASK = 250_000


def fault_code() -> Column:
    return (
        F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + F.col("l_linenumber")
    ) % 100


def cents_to_double(cents: Column) -> Column:
    """Exact cents -> double; equal to casting ``decimal(.., 2)`` to double
    (both are the correctly rounded double of the same decimal value)."""
    return cents.cast("double") / F.lit(100.0)


def _dealt(rows: DataFrame, n_parts: int, key: str) -> DataFrame:
    """``rows`` in ``n_parts`` partitions by ``key``, if the session's partitions are fewer: those would grow with the table."""
    return rows.repartition(n_parts, key) if n_parts > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def _with_dimension(rows: DataFrame, dim: DataFrame, key: str, dim_key: str, few: bool, n_parts: int) -> DataFrame:
    """``rows`` joined with a dimension: broadcast if it holds ``few`` rows, else by a shuffle.

    The shuffle join hashes the dimension's share of each of ``n_parts`` tasks
    and streams the rows past it, so that neither a large table nor a hot key
    is sorted in a task.
    """
    on = rows[key] == dim[dim_key]
    return rows.join(F.broadcast(dim), on) if few else _dealt(rows, n_parts, key).join(dim.hint("shuffle_hash"), on)


def ledger(spark: SparkSession, sf_dir: str, buyers: bool = True) -> DataFrame:
    """All 18 event columns; ``event_time`` is a timestamp (no zone).

    ``buyers=False`` leaves out the two columns that come from the order and
    its customer, and with them the only joins of two large tables: every line
    has its order and every order its customer (``tests/test_ledger.py``).
    """
    # Everything that depends on the fault code alone is computed once, on the
    # scan: price = normal * price_mult + price_add, total = price * qty +
    # total_add. Predicates pushed above the joins then see short linear
    # forms over plain columns, not re-inlined CASE chains (which bloat the
    # generated code past the JIT's method size limit).
    h = fault_code()
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_shipdate",
        h.alias("h"),
        F.when(h == 3, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("qty"),
        F.when(h == 0, F.lit(-1))
        .when(h == 2, F.lit(12))
        .when((h == 1) | h.between(7, 9), F.lit(0))
        .otherwise(F.lit(1))
        .cast("long")
        .alias("price_mult"),
        F.when(h == 1, F.lit(50))
        .when(h == 7, F.lit(PRICE_CAP * 100))
        .when(h == 9, F.lit(10_000))
        .otherwise(F.lit(0))
        .cast("long")
        .alias("price_add"),
        F.when(h == 6, F.lit(100)).otherwise(F.lit(0)).cast("long").alias("total_add"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        # Exact cents, converted once per part on the broadcast side.
        (F.col("p_retailprice").cast(MONEY) * 100).cast("long").alias("base_cents"),
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    fx = F.broadcast(
        fx_dim(spark).select("fx_id", "currency", (F.col("rate") * 10000).cast("long").alias("rate_e4"))
    )  # nine literal rows

    # With buyers the facts are shuffled on l_orderkey for the orders join, so
    # that join comes straight after the pruned, filtered scan; broadcast
    # dimensions are joined after it, on every shuffle partition. A dimension of
    # too many rows to broadcast is joined before: the last shuffle is then the
    # one on l_orderkey, whose tasks hold LINES_PER_TASK however hot a part or
    # store is. Sizes are rows counted in the footers, not estimates.
    # The hint keeps Spark from broadcasting the *fact* side when pruning and
    # pushed filters make its compressed-file estimate look small.
    def few(name: str) -> bool:
        return row_count(spark, sf_dir, name) <= broadcast_limit(spark)

    dims = [(suppliers, "l_suppkey", "s_suppkey", few("supplier")), (parts, "l_partkey", "p_partkey", few("part"))]
    n_parts = parts_for(row_count(spark, sf_dir, "lineitem"), LINES_PER_TASK) if buyers or not all(d[-1] for d in dims) else 1
    for dim in dims:
        if not dim[-1]:
            lines = _with_dimension(lines, *dim, n_parts)
    if buyers:
        buyer = _with_dimension(orders, customers, "o_custkey", "c_custkey", few("customer"), n_parts)
        order_attrs = buyer.select("o_orderkey", "o_orderpriority", "c_mktsegment").hint("shuffle_merge")
        lines = _dealt(lines, n_parts, "l_orderkey")
        lines = lines.join(order_attrs, lines.l_orderkey == order_attrs.o_orderkey)
    for dim in dims:
        if dim[-1]:
            lines = _with_dimension(lines, *dim, n_parts)
    joined = (
        lines.join(nations, F.col("s_nationkey") == nations.n_nationkey)
        .join(regions, F.col("n_regionkey") == regions.r_regionkey)
        .join(fx, (F.col("n_nationkey") % F.lit(len(FX_RATES))) == fx.fx_id)
    )

    # Money in exact integer cents (long arithmetic, no wide decimals on the
    # fact rows): normal = round(base * rate, 2) half-up, then the fault's
    # linear form.
    h = F.col("h")
    normal = F.floor((F.col("base_cents") * F.col("rate_e4") + 5000) / 10000).cast("long")
    price = normal * F.col("price_mult") + F.col("price_add")
    total = price * F.col("qty") + F.col("total_add")
    txn_id = F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
    )
    return joined.select(
        F.when(h == 5, F.lit(None).cast("string")).otherwise(txn_id).alias("transaction_id"),
        F.col("l_shipdate").alias("event_time"),
        store_code(F.col("l_suppkey")).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.concat(F.lit("City-"), F.col("s_nationkey").cast("string")).alias("city"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.when(h == 10, F.lit("XXX")).otherwise(F.col("currency")).alias("currency"),
        F.when(h == 11, F.lit("SKU-none")).otherwise(F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string"))).alias("sku"),
        F.when(h == 4, F.lit(None).cast("string")).otherwise(F.col("product_name")).alias("product_name"),
        "category",
        cents_to_double(price).alias("unit_price"),
        F.col("qty").alias("quantity"),
        F.when(h == 12, F.lit(float("inf"))).otherwise(cents_to_double(total)).alias("total_amount"),
        *([F.col("o_orderpriority").alias("payment_method"), F.col("c_mktsegment").alias("customer_type")] if buyers else []),
        ((h <= 2) | (h == 9)).alias("is_fraud_flag"),
        F.lit("1.0.0").alias("producer_version"),
    )


def iso_event_time(ts: Column) -> Column:
    """Timestamp -> ISO-8601 text with microseconds and a UTC offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def as_produced(events: DataFrame) -> DataFrame:
    """Ledger rows as the producer emits them: ``event_time`` as ISO text."""
    return events.withColumn("event_time", iso_event_time(F.col("event_time")))


def bronze_rows(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    """What parsing the topic yields, without the JSON round trip.

    ``full=False`` gives the writers' 9 fields; ``full=True`` all 18.
    """
    names = [n for n, _ in EVENT_FIELDS] if full else PARSED_FIELDS
    return ledger(spark, sf_dir, buyers=full).select(
        *[iso_event_time(F.col(n)).alias(n) if n == "event_time" else F.col(n) for n in names]
    )
