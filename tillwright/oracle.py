"""Independent SQL for every checked query, in the dialect DuckDB runs.

The driver tables are pre-registered as views. ``BASE`` rebuilds the ledger
(the driver tables in sales-event shape) and the bronze / silver / gold
layers as common table expressions; each query appends its SELECT. Names of
result columns equal those of the Spark side.
"""

from __future__ import annotations

from .schemas import FX_RATES, PRICE_CAP, REQUIRED_KEYS

_FX_VALUES = ",\n    ".join(
    f"({i}, '{cur}', CAST({rate} AS DECIMAL(10,4)))" for i, (cur, rate) in enumerate(FX_RATES)
)

BASE = f"""
WITH fx AS (
  SELECT * FROM (VALUES
    {_FX_VALUES}) AS t(fx_id, currency, rate)),
base AS (
  SELECT l.*, p_name, p_type, s_name, s_nationkey, n_name, r_name, currency,
         o_orderpriority, c_mktsegment,
         (l_orderkey*31 + l_partkey*7 + l_linenumber) % 100 AS h,
         round(CAST(p_retailprice AS DECIMAL(18,2)) * rate, 2) AS normal_price
  FROM lineitem l
  JOIN orders   ON l_orderkey  = o_orderkey
  JOIN customer ON o_custkey   = c_custkey
  JOIN part     ON l_partkey   = p_partkey
  JOIN supplier ON l_suppkey   = s_suppkey
  JOIN nation   ON s_nationkey = n_nationkey
  JOIN region   ON n_regionkey = r_regionkey
  JOIN fx       ON fx_id       = n_nationkey % {len(FX_RATES)}),
priced AS (
  SELECT *,
         CASE WHEN h=0 THEN -normal_price
              WHEN h=1 THEN CAST(0.50 AS DECIMAL(18,2))
              WHEN h=2 THEN normal_price*12
              WHEN h=7 THEN CAST({PRICE_CAP} AS DECIMAL(18,2))
              WHEN h=8 THEN CAST(0 AS DECIMAL(18,2))
              WHEN h=9 THEN CAST(100 AS DECIMAL(18,2))
              ELSE normal_price END AS price,
         CASE WHEN h=3 THEN 0 ELSE CAST(l_quantity AS INT) END AS qty
  FROM base),
ledger AS (
  SELECT CASE WHEN h=5 THEN NULL
              ELSE concat(l_orderkey,'-',l_linenumber,'-',l_partkey,'-',l_suppkey) END AS transaction_id,
         l_shipdate AS event_time,
         printf('R%04d', l_suppkey) AS store_id,
         s_name AS store_name,
         concat('City-', s_nationkey) AS city,
         n_name AS country, r_name AS region, CASE WHEN h=10 THEN 'XXX' ELSE currency END AS currency,
         CASE WHEN h=11 THEN 'SKU-none' ELSE concat('SKU-', l_partkey) END AS sku,
         CASE WHEN h=4 THEN NULL ELSE p_name END AS product_name,
         p_type AS category,
         CAST(price AS DOUBLE) AS unit_price,
         qty AS quantity,
         CASE WHEN h=12 THEN CAST('inf' AS DOUBLE)
              ELSE CAST(CASE WHEN h=6 THEN price*qty + 1 ELSE price*qty END AS DOUBLE) END AS total_amount,
         o_orderpriority AS payment_method,
         c_mktsegment AS customer_type,
         (h <= 2 OR h = 9) AS is_fraud_flag,
         '1.0.0' AS producer_version
  FROM priced),
produced AS (
  SELECT * REPLACE (strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS event_time)
  FROM ledger),
bronze AS (
  SELECT transaction_id, event_time, store_id, product_name, unit_price, quantity,
         total_amount, country, currency
  FROM produced),
typed AS (
  SELECT transaction_id, event_time, store_id, product_name, unit_price, quantity,
         total_amount, country, currency
  FROM ledger),
silver AS (
  SELECT * FROM typed
  WHERE transaction_id IS NOT NULL AND product_name IS NOT NULL
    AND unit_price > 0 AND total_amount > 0 AND unit_price < {PRICE_CAP}
    AND quantity > 0 AND isfinite(total_amount)),
gold_country AS (
  SELECT country, currency,
         CAST(ROUND(SUM(TRY_CAST(total_amount AS DECIMAL(26,6))), 2) AS DOUBLE) AS total_revenue,
         COUNT(transaction_id) AS total_transactions
  FROM silver GROUP BY country, currency),
gold_products AS (
  SELECT product_name,
         COUNT(transaction_id) AS total_transactions,
         CAST(ROUND(SUM(TRY_CAST(total_amount AS DECIMAL(26,6))), 2) AS DOUBLE) AS total_revenue
  FROM silver GROUP BY product_name),
gold_store AS (
  SELECT store_id, country,
         CAST(ROUND(SUM(TRY_CAST(total_amount AS DECIMAL(26,6))), 2) AS DOUBLE) AS total_revenue,
         COUNT(transaction_id) AS total_transactions
  FROM silver GROUP BY store_id, country),
gold_tagged AS (
  SELECT 'revenue_by_country' AS gold_table, country, currency,
         CAST(NULL AS VARCHAR) AS product_name, CAST(NULL AS VARCHAR) AS store_id,
         total_revenue, total_transactions FROM gold_country
  UNION ALL
  SELECT 'top_products', NULL, NULL, product_name, NULL, total_revenue, total_transactions
  FROM gold_products
  UNION ALL
  SELECT 'revenue_by_store', country, NULL, NULL, store_id, total_revenue, total_transactions
  FROM gold_store)
"""

_SILVER_COLS = (
    "transaction_id, event_time, store_id, product_name, unit_price, quantity, "
    "total_amount, country, currency"
)


def _q(body: str) -> str:
    return BASE + body


def _filter_rule(pred: str) -> str:
    return _q(f"SELECT * FROM bronze WHERE {pred}")


_BRONZE_COLS = _SILVER_COLS

_RULES = [
    ("transaction_id_null", "transaction_id IS NOT NULL"),
    ("product_name_null", "product_name IS NOT NULL"),
    ("unit_price_not_positive", "unit_price > 0"),
    ("total_amount_not_positive", "total_amount > 0"),
    ("unit_price_over_cap", f"unit_price < {PRICE_CAP}"),
    ("quantity_not_positive", "quantity > 0"),
    ("total_amount_not_finite", "isfinite(total_amount)"),
    ("total_amount_out_of_range", "(total_amount IS NULL OR TRY_CAST(total_amount AS DECIMAL(26,6)) IS NOT NULL)"),
]
_REASON = (
    "CASE "
    + " ".join(f"WHEN NOT coalesce({pred}, false) THEN '{name}'" for name, pred in _RULES)
    + " END"
)
_MISSING = [f"CASE WHEN {k} IS NULL THEN '{k}' END" for k in REQUIRED_KEYS]
_EXPECTED = "ROUND(CAST(unit_price AS DECIMAL(18,2)) * quantity, 2)"
_FRAUD_MISMATCH = (
    "is_fraud_flag AND NOT ((unit_price > 0 AND unit_price < 1) OR unit_price < 0 "
    "OR unit_price > 284)"
)
_ERRORS = (
    "list_filter(["
    + ", ".join(f"CASE WHEN {k} IS NULL THEN 'missing_field:{k}' END" for k in REQUIRED_KEYS)
    + ", CASE WHEN unit_price = 0 THEN 'zero_price' END"
    + ", CASE WHEN coalesce(quantity, 0) <= 0 THEN 'bad_quantity' END"
    + f", CASE WHEN TRY_CAST(total_amount AS DECIMAL(26,6)) <> {_EXPECTED} THEN 'total_mismatch' END"
    + f", CASE WHEN {_FRAUD_MISMATCH} THEN 'fraud_pattern_mismatch' END"
    + ", CASE WHEN (unit_price IS NOT NULL AND TRY_CAST(unit_price AS DECIMAL(26,6)) IS NULL) "
    + "OR (total_amount IS NOT NULL AND TRY_CAST(total_amount AS DECIMAL(26,6)) IS NULL) THEN 'amount_out_of_range' END"
    + "], lambda x: x IS NOT NULL)"
)
_PRODUCTS = (
    "(SELECT concat('SKU-', p_partkey) AS sku, p_name AS catalog_name, p_type AS catalog_category, "
    "CAST(p_retailprice AS DECIMAL(18,2)) AS base_price_usd FROM part)"
)
_STORES = (
    "(SELECT printf('R%04d', s_suppkey) AS store_id, s_name AS store_name, "
    "concat('City-', s_nationkey) AS city, r_name AS region "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)
_RATE = "COALESCE(fx.rate, CAST(1.0 AS DECIMAL(10,4)))"
_CLASSIFIED = f"""
classified AS (
  SELECT transaction_id, sku, currency, unit_price,
         CASE WHEN unit_price IS NULL THEN 'unknown'
              WHEN unit_price < 0 THEN 'negative'
              WHEN unit_price < 1 THEN 'near_zero'
              WHEN base_price_usd IS NULL THEN 'unknown'
              WHEN CAST(unit_price AS DECIMAL(18,2)) >= base_price_usd * {_RATE} * CAST(7.84 AS DECIMAL(4,2))
                THEN 'spike'
              ELSE 'normal' END AS fraud_type,
         is_fraud_flag
  FROM produced LEFT JOIN {_PRODUCTS} USING (sku) LEFT JOIN fx USING (currency)),
scored AS (
  SELECT *, fraud_type IN ('negative', 'near_zero', 'spike') AS detected FROM classified)
"""
_USD = f"""
usd AS (
  SELECT *, (CAST(CAST(total_amount AS DECIMAL(18,2)) * 100 AS BIGINT) * 20000 + r4) // (2 * r4)
            AS usd_cents
  FROM (SELECT silver.*, CAST({_RATE} * 10000 AS BIGINT) AS r4
        FROM silver LEFT JOIN fx USING (currency)))
"""


# The threshold curve by counting every row anew at each cut.
_CURVE = f"""
ratios AS (
  SELECT coalesce(is_fraud_flag, FALSE) AS truth,
         CASE WHEN unit_price < 1 THEN 10001 WHEN base_price_usd IS NULL THEN -1
              ELSE least(CAST(floor(CAST(CAST(unit_price AS DECIMAL(18,2)) * 100000000 AS HUGEINT) // CAST(base_price_usd * {_RATE} * 1000000 AS HUGEINT)) AS BIGINT), 10000) END AS bin
  FROM produced LEFT JOIN {_PRODUCTS} USING (sku) LEFT JOIN fx USING (currency)),
cuts AS (SELECT DISTINCT bin FROM ratios WHERE bin BETWEEN 0 AND 10000 UNION SELECT 784),
sums AS (
  SELECT cuts.bin, COUNT(*) FILTER (WHERE truth AND ratios.bin >= cuts.bin) AS tp, COUNT(*) FILTER (WHERE NOT truth AND ratios.bin >= cuts.bin) AS fp,
         COUNT(*) FILTER (WHERE truth) AS all_actual, COUNT(*) FILTER (WHERE NOT truth) AS all_other
  FROM cuts, ratios GROUP BY cuts.bin)
"""
_SEQUENCE = [
    "event_time", "transaction_id", "store_name", "city", "country", "region", "currency", "sku", "product_name", "category",
    "unit_price", "quantity", "total_amount", "payment_method", "customer_type", "is_fraud_flag", "producer_version",
]


def _with(extra: str, body: str) -> str:
    return BASE.rstrip() + "," + extra + body


def _dedup(src: str, cols: str) -> str:
    order = "event_time IS NULL, event_time, store_id, product_name, unit_price, quantity, total_amount, country, currency"
    return _q(
        f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id "
        f"ORDER BY {order.replace(',', ' NULLS FIRST,')} NULLS FIRST) AS rn "
        f"FROM {src} WHERE transaction_id IS NOT NULL) WHERE rn = 1"
    )


_GOLD_COUNTRY = _q("SELECT * FROM gold_country")
_GOLD_PRODUCTS = _q("SELECT * FROM gold_products")
_GOLD_STORE = _q("SELECT * FROM gold_store")
_GOLD_TAGGED = _q("SELECT * FROM gold_tagged")
_TOP_STORES = _q(
    "SELECT store_id, country, total_transactions, ROUND(total_revenue, 2) AS total_revenue "
    "FROM gold_store ORDER BY total_transactions DESC, store_id, country"
)
_SILVER = _q(f"SELECT {_SILVER_COLS} FROM silver")
_BRONZE = _q("SELECT * FROM bronze")

QUERIES: dict[str, str] = {
    # --- parsing ----------------------------------------------------------
    "publish_payload": _q("SELECT store_id AS key, * FROM produced"),
    "parse_events": _BRONZE,
    "bronze_projection": _q("SELECT * FROM produced"),
    "silver_event_time": _q("SELECT * FROM typed"),
    "silver_processed_time": _q("SELECT *, TRUE AS processed_time_set FROM typed"),
    "line_total": _q(
        f"SELECT transaction_id, unit_price, quantity, CAST({_EXPECTED} AS DOUBLE) AS line_total FROM bronze"
    ),
    # --- filters -----------------------------------------------------------
    **{
        key: _filter_rule(pred)
        for key, (_, pred) in zip(
            [
                "filter_txn_not_null",
                "filter_product_not_null",
                "filter_price_positive",
                "filter_total_positive",
                "filter_price_cap",
                "filter_quantity_positive",
                "filter_total_finite",
            ],
            _RULES,
        )
    },
    "silver_rejects": _q(
        f"SELECT * FROM (SELECT *, {_REASON} AS reject_reason FROM typed) WHERE reject_reason IS NOT NULL"
    ),
    "silver_reject_summary": _q(
        f"SELECT reject_reason, COUNT(*) AS rejected_rows FROM "
        f"(SELECT {_REASON} AS reject_reason FROM typed) WHERE reject_reason IS NOT NULL GROUP BY reject_reason"
    ),
    # --- data quality --------------------------------------------------------
    "dq_missing_fields": _q(
        f"SELECT transaction_id, missing_fields FROM (SELECT transaction_id, "
        f"concat_ws(',', {', '.join(_MISSING)}) AS missing_fields FROM ledger) WHERE missing_fields <> ''"
    ),
    "dq_zero_price": _q("SELECT transaction_id, unit_price FROM ledger WHERE unit_price = 0"),
    "dq_bad_quantity": _q(
        "SELECT transaction_id, quantity FROM ledger WHERE coalesce(quantity, 0) <= 0"
    ),
    "dq_total_mismatch": _q(
        f"SELECT transaction_id, unit_price, quantity, total_amount, "
        f"CAST({_EXPECTED} AS DOUBLE) AS expected_total FROM ledger "
        f"WHERE TRY_CAST(total_amount AS DECIMAL(26,6)) <> {_EXPECTED}"
    ),
    "dq_fraud_sanity": _q(
        f"SELECT transaction_id, unit_price FROM ledger WHERE {_FRAUD_MISMATCH}"
    ),
    "dq_errors": _q(
        f"SELECT transaction_id, CAST(len(errs) AS INTEGER) AS n_errors, "
        f"array_to_string(errs, ';') AS errors FROM (SELECT transaction_id, {_ERRORS} AS errs FROM ledger) "
        f"WHERE len(errs) > 0"
    ),
    "dq_summary": _q(
        f"SELECT COUNT(*) AS n_checked, COUNT(*) FILTER (WHERE len(errs) = 0) AS n_passed, "
        f"COUNT(*) FILTER (WHERE len(errs) > 0) AS n_failed, "
        f"COUNT(*) FILTER (WHERE coalesce(is_fraud_flag, false)) AS n_fraud "
        f"FROM (SELECT is_fraud_flag, {_ERRORS} AS errs FROM ledger)"
    ),
    # --- fraud ------------------------------------------------------------------
    "fraud_classify": _with(_CLASSIFIED, "SELECT * FROM scored"),
    "fraud_confusion": _with(
        _CLASSIFIED, "SELECT is_fraud_flag, detected, COUNT(*) AS n FROM scored GROUP BY is_fraud_flag, detected"
    ),
    "fraud_scores": _with(
        _CLASSIFIED,
        "SELECT tp, fp, fn, tn, "
        "CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS precision, "
        "CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall FROM ("
        "SELECT COUNT(*) FILTER (WHERE coalesce(is_fraud_flag, false) AND detected) AS tp, "
        "COUNT(*) FILTER (WHERE NOT coalesce(is_fraud_flag, false) AND detected) AS fp, "
        "COUNT(*) FILTER (WHERE coalesce(is_fraud_flag, false) AND NOT detected) AS fn, "
        "COUNT(*) FILTER (WHERE NOT coalesce(is_fraud_flag, false) AND NOT detected) AS tn FROM scored)",
    ),
    # --- lookups and currency -------------------------------------------------------
    "enrich_store": _q(f"SELECT * FROM bronze LEFT JOIN {_STORES} USING (store_id)"),
    "enrich_product": _q(
        f"SELECT transaction_id, sku, product_name, catalog_name, catalog_category, "
        f"CAST(base_price_usd AS DOUBLE) AS base_price_usd "
        f"FROM produced LEFT JOIN {_PRODUCTS} USING (sku)"
    ),
    "fx_local_price": _q(
        f"SELECT transaction_id, sku, currency, "
        f"CAST(round(base_price_usd * {_RATE}, 2) AS DOUBLE) AS list_price_local "
        f"FROM produced LEFT JOIN {_PRODUCTS} USING (sku) LEFT JOIN fx USING (currency)"
    ),
    "fx_usd_amount": _with(
        _USD, "SELECT transaction_id, currency, total_amount, CAST(usd_cents AS DOUBLE) / 100 AS total_usd FROM usd"
    ),
    "gold_usd_by_country": _with(
        _USD,
        "SELECT country, CAST(SUM(usd_cents) AS DOUBLE) / 100 AS total_revenue_usd, "
        "COUNT(transaction_id) AS total_transactions FROM usd GROUP BY country",
    ),
    "gold_usd_by_store": _with(
        _USD,
        "SELECT store_id, country, CAST(SUM(usd_cents) AS DOUBLE) / 100 AS total_revenue_usd, "
        "COUNT(transaction_id) AS total_transactions FROM usd GROUP BY store_id, country",
    ),
    "gold_usd_by_product": _with(
        _USD,
        "SELECT product_name, CAST(SUM(usd_cents) AS DOUBLE) / 100 AS total_revenue_usd, "
        "COUNT(transaction_id) AS total_transactions FROM usd GROUP BY product_name",
    ),
    "gold_usd_one_scan": _with(
        _USD,
        " UNION ALL ".join(
            f"SELECT '{name}' AS usd_table, {', '.join(k if k in by else f'CAST(NULL AS VARCHAR) AS {k}' for k in ('country', 'store_id', 'product_name'))}, "
            f"CAST(SUM(usd_cents) AS DOUBLE) / 100 AS total_revenue_usd, COUNT(transaction_id) AS total_transactions FROM usd GROUP BY {', '.join(by)}"
            for name, by in (("country", ["country"]), ("store", ["store_id", "country"]), ("product", ["product_name"]))
        ),
    ),
    "dedup_transactions": _dedup("bronze", _BRONZE_COLS),
    # --- lake ---------------------------------------------------------------------------
    "scan_silver": _SILVER,
    "scan_gold": _GOLD_TAGGED,
    "gold_views": _TOP_STORES,
    "gold_roundtrip": _GOLD_TAGGED,
    "csv_export_country": _GOLD_COUNTRY,
    "csv_export_products": _GOLD_PRODUCTS,
    "csv_export_store": _GOLD_STORE,
    # --- streaming (read back from the sink; same answer as the batch operator) ----------
    "stream_bronze": _BRONZE,
    "stream_restart": _BRONZE,
    "stream_tail": _BRONZE,
    "stream_silver": _SILVER,
    "stream_gold_country": _GOLD_COUNTRY,
    "stream_gold_products": _GOLD_PRODUCTS,
    "stream_gold_store": _GOLD_STORE,
    "stream_gold_all": _GOLD_TAGGED,
    "stream_rejects": _q(
        f"SELECT * FROM (SELECT *, {_REASON} AS reject_reason FROM typed) WHERE reject_reason IS NOT NULL"
    ),
    "stream_dedup": _dedup("typed", _BRONZE_COLS),
    "stream_dedup_batches": _q(
        "SELECT DISTINCT transaction_id, store_id, product_name, unit_price, country, currency FROM typed WHERE transaction_id IS NOT NULL"
    ),
    "stream_gold_deltas": _GOLD_TAGGED,
    "publish_ordered": _q(
        "SELECT store_id AS key, row_number() OVER (PARTITION BY store_id ORDER BY "
        + ", ".join(f"{c} NULLS FIRST" for c in _SEQUENCE)
        + ") AS seq, * FROM produced"
    ),
    "dq_unparsed_fields": _q(
        "SELECT transaction_id, CASE WHEN quantity % 8 <= 3 THEN 'quantity' WHEN quantity % 8 = 4 THEN 'unit_price' "
        "WHEN quantity % 8 = 5 THEN 'is_fraud_flag' ELSE 'total_amount' END AS unparsed_fields FROM produced WHERE quantity % 8 BETWEEN 1 AND 6"
    ),
    "fraud_curve": _with(
        _CURVE,
        "SELECT CAST(bin AS DOUBLE) / 100 AS cut, tp, fp, all_actual - tp AS fn, all_other - fp AS tn, "
        "CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS precision, "
        "CASE WHEN all_actual > 0 THEN CAST(tp AS DOUBLE) / all_actual END AS recall FROM sums",
    ),
    "gold_distinct_sketches": _q(
        "SELECT country, COUNT(DISTINCT transaction_id) AS sales, COUNT(DISTINCT store_id) AS stores, "
        "TRUE AS sales_within_error, TRUE AS stores_within_error FROM silver GROUP BY country"
    ),
    "stream_dedup_late": _dedup("typed", _BRONZE_COLS),
    "stream_split": _q(
        f"SELECT {_SILVER_COLS}, CASE WHEN reject_reason IS NULL THEN 'silver' ELSE 'rejects' END AS dataset, reject_reason "
        f"FROM (SELECT *, {_REASON} AS reject_reason FROM typed)"
    ),
    "gold_incremental": _GOLD_TAGGED,
    "compacted_silver": _SILVER,
    "store_revenue": _q("SELECT * FROM gold_store WHERE store_id = (SELECT min(store_id) FROM silver)"),
    "raw_revenue_by_country": _q("SELECT * FROM gold_country ORDER BY total_transactions DESC, country, currency"),
    "raw_top_products": _q("SELECT * FROM gold_products ORDER BY total_transactions DESC, product_name NULLS LAST"),
    "raw_revenue_by_store": _q("SELECT * FROM gold_store ORDER BY total_transactions DESC, store_id, country"),
    # --- silver ---------------------------------------------------------
    "silver_clean": _q(f"SELECT {_SILVER_COLS} FROM silver"),
    "silver_row_count": _q("SELECT COUNT(*) AS n_rows FROM silver"),
    # --- gold -----------------------------------------------------------
    "gold_revenue_by_country": _q("SELECT * FROM gold_country"),
    "gold_top_products": _q("SELECT * FROM gold_products"),
    "gold_revenue_by_store": _q("SELECT * FROM gold_store"),
    "gold_tables_one_scan": _q("SELECT * FROM gold_tagged"),
    # --- reports and KPIs -------------------------------------------------
    "report_revenue_by_country": _q(
        "SELECT country, currency, total_transactions, ROUND(total_revenue, 2) AS total_revenue "
        "FROM gold_country ORDER BY total_transactions DESC, country, currency"
    ),
    "report_top10_products": _q(
        "SELECT product_name, total_transactions, ROUND(total_revenue, 2) AS total_revenue "
        "FROM gold_products ORDER BY total_transactions DESC, product_name NULLS LAST LIMIT 10"
    ),
    "report_top_stores": _q(
        "SELECT store_id, country, total_transactions, ROUND(total_revenue, 2) AS total_revenue "
        "FROM gold_store ORDER BY total_transactions DESC, store_id, country"
    ),
    "kpi_total_transactions": _q(
        "SELECT CAST(SUM(total_transactions) AS BIGINT) AS total_transactions FROM gold_country"
    ),
    "kpi_total_countries": _q(
        "SELECT COUNT(DISTINCT country) AS total_countries FROM gold_country"
    ),
    "kpi_country_groups": _q("SELECT COUNT(*) AS country_groups FROM gold_country"),
    "kpi_best_product": _q(
        "SELECT (SELECT product_name FROM gold_products "
        "ORDER BY total_transactions DESC, product_name NULLS FIRST LIMIT 1) AS best_product"
    ),
    "kpi_busiest_store": _q(
        "SELECT (SELECT store_id FROM gold_store "
        "ORDER BY total_transactions DESC, store_id NULLS FIRST LIMIT 1) AS busiest_store"
    ),
    "kpi_row": _q(
        "SELECT (SELECT CAST(SUM(total_transactions) AS BIGINT) FROM gold_country) AS total_transactions, "
        "(SELECT COUNT(DISTINCT country) FROM gold_country) AS total_countries, "
        "(SELECT COUNT(*) FROM gold_country) AS country_groups, "
        "(SELECT product_name FROM gold_products "
        " ORDER BY total_transactions DESC, product_name NULLS FIRST LIMIT 1) AS best_product, "
        "(SELECT store_id FROM gold_store "
        " ORDER BY total_transactions DESC, store_id NULLS FIRST LIMIT 1) AS busiest_store"
    ),
}


def oracle_sql() -> dict[str, str]:
    return dict(QUERIES)
