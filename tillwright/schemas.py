"""Schemas and fixed values of the sales-event model.

Money travels as double at the surface (as the event producer emits it) and
is summed as decimal so results do not depend on partition order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: must equal the event producer's contract ----------------
# The 18 keys of a produced sales event, in producer order.
EVENT_FIELDS = [
    ("transaction_id", T.StringType()),
    ("event_time", T.StringType()),
    ("store_id", T.StringType()),
    ("store_name", T.StringType()),
    ("city", T.StringType()),
    ("country", T.StringType()),
    ("region", T.StringType()),
    ("currency", T.StringType()),
    ("sku", T.StringType()),
    ("product_name", T.StringType()),
    ("category", T.StringType()),
    ("unit_price", T.DoubleType()),
    ("quantity", T.IntegerType()),
    ("total_amount", T.DoubleType()),
    ("payment_method", T.StringType()),
    ("customer_type", T.StringType()),
    ("is_fraud_flag", T.BooleanType()),
    ("producer_version", T.StringType()),
]

# The 9 fields the bronze and silver writers keep (parity mode), in order.
PARSED_FIELDS = [
    "transaction_id",
    "event_time",
    "store_id",
    "product_name",
    "unit_price",
    "quantity",
    "total_amount",
    "country",
    "currency",
]

# Keys the QA check requires to be present in every event, in check order.
REQUIRED_KEYS = [
    "transaction_id",
    "event_time",
    "store_id",
    "country",
    "product_name",
    "category",
    "unit_price",
    "quantity",
    "total_amount",
    "payment_method",
]

# Units of local currency per US dollar; unknown currencies count as 1.0.
FX_RATES = [
    ("USD", "1.00"),
    ("GBP", "0.79"),
    ("EUR", "0.92"),
    ("AED", "3.67"),
    ("SGD", "1.35"),
    ("CNY", "7.24"),
    ("JPY", "149.5"),
    ("INR", "83.2"),
    ("AUD", "1.53"),
]
FX_DEFAULT_RATE = "1.0"

# Silver price cap in local currency (exclusive).
PRICE_CAP = 10_000_000

# Fraud shapes injected by the producer: a normal price is base * rate *
# [0.98, 1.02]; a spike multiplies it by [8, 20]; near-zero is 0.01-0.99.
NORMAL_BAND_LOW = "0.98"
SPIKE_FACTOR_LOW = 8
NEAR_ZERO_LIMIT = 1
# QA script's spike threshold for flagged rows (not a true bound; kept as is).
QA_SPIKE_THRESHOLD = 284
# --- end of fixed values -----------------------------------------------------

EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in EVENT_FIELDS])
# The writers' 9-field declaration order.
PARSED_SCHEMA = T.StructType(
    [next(f for f in EVENT_SCHEMA.fields if f.name == n) for n in PARSED_FIELDS]
)

MONEY = T.DecimalType(18, 2)
# An event's amount: six decimals are summed and rounded once at the end. An
# amount beyond it (or NaN, Infinity) has no value here and is reported.
AMOUNT = T.DecimalType(26, 6)
USD_AMOUNT = T.DecimalType(26, 2)
RATE = T.DecimalType(10, 4)

# Silver as read back from its partitioned folder: the partition column last.
SILVER_READ_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("processed_time", T.TimestampType()),
        T.StructField("country", T.StringType()),
    ]
)

BRONZE_READ_SCHEMA = T.StructType(
    [f for f in PARSED_SCHEMA.fields if f.name != "country"]
    + [T.StructField("country", T.StringType())]
)

# The parsed fields with a typed time.
TYPED_SCHEMA = T.StructType(
    [T.StructField(f.name, T.TimestampNTZType() if f.name == "event_time" else f.dataType) for f in PARSED_SCHEMA.fields]
)

# Silver and its rejects in one batch table.
SPLIT_SCHEMA = T.StructType([*SILVER_READ_SCHEMA.fields, T.StructField("reject_reason", T.StringType())])

# Rows of the three gold tables in one frame; keys a table does not group by are null.
GOLD_DELTA_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("country", "currency", "product_name", "store_id")]
    + [T.StructField("total_revenue", T.DoubleType()), T.StructField("total_transactions", T.LongType())]
)

# Message shape of the topic: Kafka-compatible key/value text.
MESSAGE_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

GOLD_SCHEMAS = {
    "revenue_by_country": T.StructType(
        [
            T.StructField("country", T.StringType()),
            T.StructField("currency", T.StringType()),
            T.StructField("total_revenue", T.DoubleType()),
            T.StructField("total_transactions", T.LongType()),
        ]
    ),
    "top_products": T.StructType(
        [
            T.StructField("product_name", T.StringType()),
            T.StructField("total_transactions", T.LongType()),
            T.StructField("total_revenue", T.DoubleType()),
        ]
    ),
    "revenue_by_store": T.StructType(
        [
            T.StructField("store_id", T.StringType()),
            T.StructField("country", T.StringType()),
            T.StructField("total_revenue", T.DoubleType()),
            T.StructField("total_transactions", T.LongType()),
        ]
    ),
}
