"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through the ledger) over their whole
extent; none caps, samples or subsets rows.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import scratch_path
from .functions import line_total as exact_line_total
from .functions.once import computed_once
from .operators import clean as C
from .operators import dedup as D
from .operators import enrich as E
from .operators import fraud as FR
from .operators import gold as G
from .operators import quality as Q
from .operators import reports as R
from .operators.parse import parse_events, with_event_time, with_processed_time
from .plans import batches as B
from .plans import idindex as IX
from .plans import lake as L
from .plans.files import children, remove
from .schemas import BRONZE_READ_SCHEMA, EVENT_SCHEMA, GOLD_SCHEMAS, PARSED_FIELDS, SPLIT_SCHEMA, TYPED_SCHEMA
from .sources.dims import fx_dim, product_dim, store_dim
from .sources.ledger import bronze_rows, ledger
from .sources.tables import parts_for, row_count
from .sources.topic import ordered_messages, read_events, resent, to_messages, write_topic
from .streaming import jobs as S

Query = Callable[[SparkSession, str], DataFrame]

# Messages of one file where a query deals the topic to a given number of micro-batches.
MESSAGES_PER_FILE = 1_000_000
# Micro-batches that a topic of many files is read in, at most about this many.
MICRO_BATCHES = 8


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver without the ingest stamp (constant per batch, not comparable)."""
    return C.silver(bronze_rows(spark, sf_dir), stamp=False)


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: G.gold_table(_silver(spark, sf_dir), name)


def _gold_unsorted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return G.gold_table(_silver(spark, sf_dir), name, sort=False)


def silver_clean(spark, sf_dir):
    return _silver(spark, sf_dir)


def silver_row_count(spark, sf_dir):
    return G.row_count(_silver(spark, sf_dir))


def gold_tables_one_scan(spark, sf_dir):
    return G.gold_all(_silver(spark, sf_dir))


def report_revenue_by_country(spark, sf_dir):
    return R.report_revenue_by_country(_gold_unsorted(spark, sf_dir, G.COUNTRY))


def report_top10_products(spark, sf_dir):
    return R.report_top_products(_gold_unsorted(spark, sf_dir, G.PRODUCTS), 10)


def report_top_stores(spark, sf_dir):
    return R.report_top_stores(_gold_unsorted(spark, sf_dir, G.STORE))


def kpi_total_transactions(spark, sf_dir):
    return R.kpi_total_transactions(_gold_unsorted(spark, sf_dir, G.COUNTRY))


def kpi_total_countries(spark, sf_dir):
    return R.kpi_total_countries(_gold_unsorted(spark, sf_dir, G.COUNTRY))


def kpi_country_groups(spark, sf_dir):
    return R.kpi_country_groups(_gold_unsorted(spark, sf_dir, G.COUNTRY))


def kpi_best_product(spark, sf_dir):
    return R.kpi_best_product(_gold_unsorted(spark, sf_dir, G.PRODUCTS))


def kpi_busiest_store(spark, sf_dir):
    return R.kpi_busiest_store(_gold_unsorted(spark, sf_dir, G.STORE))


def kpi_row(spark, sf_dir):
    return R.kpi_row(G.gold_all(_silver(spark, sf_dir)))


# --- parsing ----------------------------------------------------------------


def _messages(spark, sf_dir, ordered: bool = False):
    """The topic's messages; consumers need no publish order."""
    return to_messages(ledger(spark, sf_dir), ordered=ordered)


def publish_payload(spark, sf_dir):
    """Keyed JSON messages as published: the key, and the 18 fields read back from the text."""
    return parse_events(_messages(spark, sf_dir, ordered=True), full=True, keep_key=True)


def parse_events_q(spark, sf_dir):
    return parse_events(_messages(spark, sf_dir))


def bronze_projection(spark, sf_dir):
    """Full mode: all 18 producer fields survive parsing (raw text dropped here)."""
    return parse_events(_messages(spark, sf_dir), full=True)


def silver_event_time(spark, sf_dir):
    return with_event_time(parse_events(_messages(spark, sf_dir)))


def silver_processed_time(spark, sf_dir):
    stamped = with_processed_time(with_event_time(bronze_rows(spark, sf_dir)))
    return stamped.withColumn("processed_time_set", F.col("processed_time").isNotNull()).drop(
        "processed_time"
    )


# --- filters ------------------------------------------------------------------


def _filter(rule_name: str) -> Query:
    return lambda spark, sf_dir: C.filter_rule(bronze_rows(spark, sf_dir), rule_name)


def silver_rejects(spark, sf_dir):
    return C.rejects(bronze_rows(spark, sf_dir))


def silver_reject_summary(spark, sf_dir):
    return C.reject_summary(bronze_rows(spark, sf_dir))


def line_total(spark, sf_dir):
    return bronze_rows(spark, sf_dir).select(
        "transaction_id",
        "unit_price",
        "quantity",
        exact_line_total("unit_price", "quantity").cast("double").alias("line_total"),
    )


# --- data quality and fraud ----------------------------------------------------


def _checked(spark, sf_dir):
    """Fully parsed events with their raw JSON, as the QA rules need."""
    return parse_events(_messages(spark, sf_dir), full=True, keep_raw=True)


def _full(spark, sf_dir):
    return bronze_rows(spark, sf_dir, full=True)


def dq_missing_fields(spark, sf_dir):
    return Q.missing_field_rows(_checked(spark, sf_dir))


def dq_zero_price(spark, sf_dir):
    return Q.zero_price_rows(_full(spark, sf_dir))


def dq_bad_quantity(spark, sf_dir):
    return Q.bad_quantity_rows(_full(spark, sf_dir))


def dq_total_mismatch(spark, sf_dir):
    return Q.total_mismatch_rows(_full(spark, sf_dir))


def dq_fraud_sanity(spark, sf_dir):
    return Q.fraud_sanity_rows(_full(spark, sf_dir))


def dq_errors(spark, sf_dir):
    return Q.error_rows(_checked(spark, sf_dir))


def dq_summary(spark, sf_dir):
    return Q.summary(_checked(spark, sf_dir))


def _classified(spark, sf_dir):
    return FR.classify(_full(spark, sf_dir), product_dim(spark, sf_dir), fx_dim(spark))


def fraud_classify(spark, sf_dir):
    return _classified(spark, sf_dir)


def fraud_confusion(spark, sf_dir):
    return FR.confusion(_classified(spark, sf_dir))


def fraud_scores(spark, sf_dir):
    return FR.scores(_classified(spark, sf_dir))


# --- lookups and currency --------------------------------------------------------


def enrich_store(spark, sf_dir):
    return E.enrich_store(bronze_rows(spark, sf_dir), store_dim(spark, sf_dir))


def enrich_product(spark, sf_dir):
    events = _full(spark, sf_dir).select("transaction_id", "sku", "product_name")
    return E.enrich_product(events, product_dim(spark, sf_dir)).withColumn(
        "base_price_usd", F.col("base_price_usd").cast("double")
    )


def fx_local_price(spark, sf_dir):
    return E.local_list_price(_full(spark, sf_dir), product_dim(spark, sf_dir), fx_dim(spark))


def fx_usd_amount(spark, sf_dir):
    return E.usd_amounts(_silver(spark, sf_dir), fx_dim(spark))


def _usd(by: str) -> Query:
    return lambda spark, sf_dir: E.usd_revenue(_silver(spark, sf_dir), fx_dim(spark), by)


def gold_usd_one_scan(spark, sf_dir):
    return E.usd_tables(_silver(spark, sf_dir), fx_dim(spark))


def _later_text(event_time):
    """A later instant whose text sorts before the given one (other offset), or no time at all."""
    day_before = F.date_format(F.to_timestamp_ntz(F.substring(event_time, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")) - F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.col("quantity") % 2 == 0, F.lit("unreadable")).otherwise(F.concat(day_before, F.lit("-05:00")))


def dedup_transactions(spark, sf_dir):
    """Every event arrives again, later or with an unreadable time; the earliest readable copy of an id remains."""
    events = bronze_rows(spark, sf_dir)
    return D.dedup_transactions(events.withColumn("event_time", _later_text(F.col("event_time"))).unionByName(events))


# --- lake reads and writes -------------------------------------------------------


def scan_silver(spark, sf_dir):
    path = scratch_path(spark, "silver")
    L.write_silver(C.silver(bronze_rows(spark, sf_dir)), path)
    return L.read_silver(spark, path).drop("processed_time")


def _published(spark, sf_dir) -> str:
    root = scratch_path(spark, "gold")
    L.publish_gold(_silver(spark, sf_dir), root)
    return root


def scan_gold(spark, sf_dir):
    root = _published(spark, sf_dir)
    return G.tagged_gold(L.read_gold_globs(spark, root))


def gold_roundtrip(spark, sf_dir):
    """Publish twice; readers see exactly the latest version, never a mix."""
    root = _published(spark, sf_dir)
    L.publish_gold(_silver(spark, sf_dir), root)
    return G.tagged_gold(L.read_gold_tables(spark, root))


def gold_views(spark, sf_dir):
    L.gold_views(spark, _published(spark, sf_dir))
    return spark.sql(
        "SELECT store_id, country, total_transactions, ROUND(total_revenue, 2) AS total_revenue "
        "FROM revenue_by_store ORDER BY total_transactions DESC, store_id, country"
    )


def _csv(name: str) -> Query:
    def run(spark, sf_dir):
        root = _published(spark, sf_dir)
        out = scratch_path(spark, f"csv-{name}")
        L.export_csv(
            L.read_gold(spark, root, name),
            out,
            [F.col("total_transactions").desc(), *[F.col(k).asc_nulls_last() for k in G.KEYS[name]]],
        )
        return L.read_csv(spark, out, GOLD_SCHEMAS[name])

    return run


# --- streaming ----------------------------------------------------------------------


def _topic(spark, sf_dir, copies: int = 1) -> str:
    path = scratch_path(spark, "topic")
    msgs = _messages(spark, sf_dir, ordered=True)
    write_topic(resent(msgs, copies) if copies > 1 else msgs, path)
    return path


def _dealt(spark, sf_dir, messages: DataFrame, n: int, copies: int = 1) -> tuple[str, int]:
    """A topic of ``messages``, each ``copies`` times, for ``n`` micro-batches, and the files of each: one, or as many as keep a file at MESSAGES_PER_FILE.

    Messages are written once, then dealt by place and copy, one micro-batch after the other: what lies
    on disk beside the topic is one copy and the shuffle of one micro-batch.
    """
    files = parts_for(row_count(spark, sf_dir, "lineitem") * copies, n * MESSAGES_PER_FILE)
    topic, whole = scratch_path(spark, "topic"), scratch_path(spark, "undealt")
    write_topic(messages, whole)
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    sent = resent(spark.read.schema(messages.schema).parquet(whole).select("*", *place), copies, "_copy")
    deal = F.pmod(F.xxhash64("_file", "_row", "_copy"), F.lit(n))
    for k in range(n):
        write_topic(sent.filter(deal == k).repartition(files, "_file", "_row").select(*messages.columns), topic)
    remove(spark, whole)
    return topic, files


def _files_per_batch(spark, topic: str, at_least: int) -> int:
    """``at_least`` files a micro-batch, more where the topic has so many files that batches would grow with it."""
    files = sum(path.endswith(".parquet") for path, _ in children(spark, topic))
    return max(at_least, parts_for(files, MICRO_BATCHES))


def stream_bronze(spark, sf_dir):
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt-bronze")
    stream = S.bronze_stream(read_events(spark, topic))
    S.run_until_done(S.start_file_sink(stream, sink, ckpt, available_now=True))
    return L.read_bronze(spark, sink, BRONZE_READ_SCHEMA)


def stream_restart(spark, sf_dir):
    """Run the bronze stream twice on one checkpoint; the rerun adds nothing."""
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt-bronze")
    for _ in range(2):
        stream = S.bronze_stream(read_events(spark, topic))
        S.run_until_done(S.start_file_sink(stream, sink, ckpt, available_now=True))
    return L.read_bronze(spark, sink, BRONZE_READ_SCHEMA)


def stream_tail(spark, sf_dir):
    """A tail sees exactly the events that arrive after it started: not those already there."""
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "tail"), scratch_path(spark, "ckpt-tail")
    time.sleep(0.01)
    started = dt.datetime.now(dt.timezone.utc)

    def run():
        stream = S.bronze_stream(read_events(spark, topic, starting="latest", since=started))
        S.run_until_done(S.start_file_sink(stream, sink, ckpt, partition_by=(), available_now=True))

    run()
    write_topic(_messages(spark, sf_dir, ordered=True), topic)
    run()
    return spark.read.schema(BRONZE_READ_SCHEMA).parquet(sink).select(*PARSED_FIELDS)


def stream_silver(spark, sf_dir):
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "silver"), scratch_path(spark, "ckpt-silver")
    stream = S.silver_stream(read_events(spark, topic))
    S.run_until_done(S.start_file_sink(stream, sink, ckpt, available_now=True))
    return L.read_silver(spark, sink).drop("processed_time")


def _stream_gold(name: str) -> Query:
    def run(spark, sf_dir):
        topic = _topic(spark, sf_dir)
        root, ckpt = scratch_path(spark, "live-gold"), scratch_path(spark, f"ckpt-{name}")
        stream = S.silver_stream(read_events(spark, topic))
        S.run_until_done(S.start_live_gold(stream, name, root, ckpt, available_now=True))
        return L.read_gold(spark, root, name)

    return run


def stream_gold_all(spark, sf_dir):
    """The three gold tables kept live by one streaming aggregation."""
    topic = _topic(spark, sf_dir)
    root, ckpt = scratch_path(spark, "live-gold-all"), scratch_path(spark, "ckpt-gold-all")
    stream = S.silver_stream(read_events(spark, topic))
    S.run_until_done(S.start_live_gold_all(stream, root, ckpt, available_now=True))
    return G.tagged_gold(L.read_gold_tables(spark, root))


def stream_rejects(spark, sf_dir):
    """What the silver stream drops, with the first rule each row fails."""
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "rejects"), scratch_path(spark, "ckpt-rejects")
    S.run_until_done(S.start_file_sink(S.rejects_stream(read_events(spark, topic)), sink, ckpt, partition_by=(), available_now=True))
    return spark.read.parquet(sink)


def stream_dedup_batches(spark, sf_dir):
    """Every event published twice, in files not ordered by time, six micro-batches
    (of one file each, while it is no larger than MESSAGES_PER_FILE): rows far older than those before them are kept, once."""
    topic, files = _dealt(spark, sf_dir, _messages(spark, sf_dir), 6, copies=2)
    sink, ckpt = scratch_path(spark, "dedup"), scratch_path(spark, "ckpt-dedup")
    stream = S.dedup_stream(S.typed_stream(read_events(spark, topic, max_files_per_trigger=files)))
    S.run_until_done(S.start_file_sink(stream, sink, ckpt, partition_by=(), available_now=True))
    # Two lines may share an id: which of them arrives first is open, so only what the id determines is compared.
    return spark.read.parquet(sink).select("transaction_id", "store_id", "product_name", "unit_price", "country", "currency")


def _raw(name: str) -> Query:
    """A raw table of the dashboard, ordered by transactions."""
    def run(spark, sf_dir):
        silver = _silver(spark, sf_dir)
        return R.dashboard_frames({n: G.gold_table(silver, n, sort=False) for n in G.GOLD_TABLES})[f"raw_{name}"]

    return run


def stream_dedup(spark, sf_dir):
    """Every event published twice; the watermark dedup keeps one per id."""
    topic = _topic(spark, sf_dir, copies=2)
    sink, ckpt = scratch_path(spark, "dedup"), scratch_path(spark, "ckpt-dedup")
    stream = S.dedup_stream(S.typed_stream(read_events(spark, topic)))
    S.run_until_done(S.start_file_sink(stream, sink, ckpt, partition_by=(), available_now=True))
    return spark.read.parquet(sink)


# --- batch tables: one commit per batch ----------------------------------------------


def _split(spark, topic: str, root: str, ckpt: str, files_per_batch: int) -> None:
    stream = S.split_stream(read_events(spark, topic, max_files_per_trigger=_files_per_batch(spark, topic, files_per_batch)))
    S.run_until_done(S.start_batch_sink(stream, root, ckpt, available_now=True))


def stream_split(spark, sf_dir):
    """Silver and rejects from one parse and one commit per micro-batch, read back with the data set each row went to."""
    topic = _topic(spark, sf_dir)
    root, ckpt = scratch_path(spark, "split"), scratch_path(spark, "ckpt-split")
    for _ in range(2):
        _split(spark, topic, root, ckpt, files_per_batch=4)
    return B.read(spark, root, SPLIT_SCHEMA).drop(B.BATCH, "processed_time")


def _appended(spark, sf_dir, root: str, parts: int = 3) -> list[DataFrame]:
    """Silver in ``parts`` batches, cut by day of sale; each is a frame that a caller appends."""
    silver = _silver(spark, sf_dir).withColumns({"processed_time": F.current_timestamp(), "reject_reason": F.lit(None).cast("string"), B.DATASET: F.lit("silver")})
    day = F.pmod(F.datediff("event_time", F.lit("1970-01-01").cast("timestamp_ntz")), F.lit(parts))
    return [silver.filter(F.coalesce(day, F.lit(0)) == k) for k in range(parts)]


def gold_incremental(spark, sf_dir):
    """Three batches, gold published after each, with a compaction in between: as one publish of the whole."""
    table, root = scratch_path(spark, "batches"), scratch_path(spark, "gold-incremental")
    for k, rows in enumerate(_appended(spark, sf_dir, table)):
        B.append(rows, table, "load", k)
        if k == 1:
            B.compact(spark, table, SPLIT_SCHEMA)
        L.publish_incremental(spark, table, root, SPLIT_SCHEMA)
    return G.tagged_gold(L.read_gold_tables(spark, root))


def compacted_silver(spark, sf_dir):
    """The split stream's silver after a compaction and a restart of the stream."""
    topic = _topic(spark, sf_dir)
    root, ckpt = scratch_path(spark, "compacted"), scratch_path(spark, "ckpt-compacted")
    _split(spark, topic, root, ckpt, files_per_batch=3)
    B.compact(spark, root, SPLIT_SCHEMA)
    _split(spark, topic, root, ckpt, files_per_batch=3)
    return B.read(spark, root, SPLIT_SCHEMA, "silver").drop(B.BATCH, "processed_time", "reject_reason")


def store_revenue(spark, sf_dir):
    """Revenue by country of the store with the smallest id, from only the files that may hold it."""
    root = scratch_path(spark, "clustered")
    for k, rows in enumerate(_appended(spark, sf_dir, root)):
        B.append(rows, root, "load", k)
    B.compact(spark, root, SPLIT_SCHEMA, target_bytes=64 << 10)
    store = B.read(spark, root, SPLIT_SCHEMA, "silver").agg(F.min("store_id")).first()[0]
    rows = B.read_where(spark, root, SPLIT_SCHEMA, "store_id", store, "silver")
    return G.gold_table(rows, G.STORE, sort=False)


def stream_dedup_late(spark, sf_dir):
    """Every event arrives, and again in a later run with another time, long after any streaming state: one row per id."""
    topic = _topic(spark, sf_dir)
    root, ckpt = scratch_path(spark, "dedup-index"), scratch_path(spark, "ckpt-dedup-index")

    def run() -> None:
        S.run_until_done(S.start_dedup_index(S.typed_stream(read_events(spark, topic)), root, ckpt, available_now=True))

    run()
    again = ledger(spark, sf_dir).withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 400 DAYS"))
    write_topic(to_messages(again, ordered=False), topic)
    run()
    return IX.read(spark, root, TYPED_SCHEMA)


def stream_gold_deltas(spark, sf_dir):
    """Live gold as changes: only the groups that a micro-batch changed are written; the last row of each group is gold."""
    topic, files = _dealt(spark, sf_dir, _messages(spark, sf_dir), 4)
    root, ckpt = scratch_path(spark, "gold-deltas"), scratch_path(spark, "ckpt-deltas")
    stream = S.silver_stream(read_events(spark, topic, max_files_per_trigger=files))
    S.run_until_done(S.start_live_gold_deltas(stream, root, ckpt, available_now=True))
    S.compact_live_gold(spark, root)
    return S.live_gold_now(spark, root)


def publish_ordered(spark, sf_dir):
    """Messages with their gapless number within the store, read back."""
    sent = ordered_messages(ledger(spark, sf_dir))
    return sent.select("key", "seq", F.inline(F.array(F.from_json("value", EVENT_SCHEMA))))


def _mistyped(value, pick):
    """JSON text with one field of a wrong type, chosen by ``pick``."""
    swap = [
        ('"quantity":([0-9]+)', '"quantity":"$1"'), ('"quantity":([0-9]+)', '"quantity":$1.0'), ('"quantity":([0-9]+)', '"quantity":3e9'),
        ('"unit_price":([-0-9.E]+)', '"unit_price":"$1 USD"'), ('"is_fraud_flag":(true|false)', '"is_fraud_flag":"yes"'),
        ('"total_amount":[^,]+', '"total_amount":[1]'),
    ]
    out = value
    for k, (pattern, new) in enumerate(swap, 1):
        out = F.when(pick == k, F.regexp_replace(value, pattern, new)).otherwise(out)
    return out


def dq_unparsed_fields(spark, sf_dir):
    """Fields that the typed parse nulls because of their type, over messages with such fields planted."""
    pick = F.get_json_object("value", "$.quantity").cast("int") % 8
    messages = computed_once(_messages(spark, sf_dir), "_pick", pick)
    return Q.unparsed_fields(messages.withColumn("value", _mistyped(F.col("value"), F.col("_pick"))))


def fraud_curve(spark, sf_dir):
    return FR.curve(_full(spark, sf_dir), product_dim(spark, sf_dir), fx_dim(spark))


def gold_distinct_sketches(spark, sf_dir):
    """Distinct sale ids and stores per country, from sketches by (country, currency) merged by country, held against the exact counts."""
    silver = _silver(spark, sf_dir)
    by, out = ["country", "currency"], None
    for column, name in (("transaction_id", "sales"), ("store_id", "stores")):
        merged = G.merged_sketches(G.distinct_sketches(silver, by, column), ["country"]).select("country", G.sketch_estimate(f"{name}_estimate"))
        out = merged if out is None else out.join(merged, "country")
    exact = silver.groupBy("country").agg(F.count_distinct("transaction_id").alias("sales"), F.count_distinct("store_id").alias("stores"))
    near = [(F.abs(F.col(f"{n}_estimate") - F.col(n)) <= F.ceil(F.col(n) * G.SKETCH_ERROR)).alias(f"{n}_within_error") for n in ("sales", "stores")]
    return out.join(exact, "country").select("country", "sales", "stores", *near)


QUERIES: dict[str, Query] = {
    # sources, parsing
    "publish_payload": publish_payload,
    "parse_events": parse_events_q,
    "bronze_projection": bronze_projection,
    "silver_event_time": silver_event_time,
    "silver_processed_time": silver_processed_time,
    "line_total": line_total,
    # filters
    "filter_txn_not_null": _filter("transaction_id_null"),
    "filter_product_not_null": _filter("product_name_null"),
    "filter_price_positive": _filter("unit_price_not_positive"),
    "filter_total_positive": _filter("total_amount_not_positive"),
    "filter_price_cap": _filter("unit_price_over_cap"),
    "filter_quantity_positive": _filter("quantity_not_positive"),
    "filter_total_finite": _filter("total_amount_not_finite"),
    "silver_rejects": silver_rejects,
    "silver_reject_summary": silver_reject_summary,
    # quality, fraud
    "dq_missing_fields": dq_missing_fields,
    "dq_zero_price": dq_zero_price,
    "dq_bad_quantity": dq_bad_quantity,
    "dq_total_mismatch": dq_total_mismatch,
    "dq_fraud_sanity": dq_fraud_sanity,
    "dq_errors": dq_errors,
    "dq_summary": dq_summary,
    "fraud_classify": fraud_classify,
    "fraud_confusion": fraud_confusion,
    "fraud_scores": fraud_scores,
    # lookups, currency
    "enrich_store": enrich_store,
    "enrich_product": enrich_product,
    "fx_local_price": fx_local_price,
    "fx_usd_amount": fx_usd_amount,
    "gold_usd_by_country": _usd("country"),
    "gold_usd_by_store": _usd("store"),
    "gold_usd_by_product": _usd("product"),
    "gold_usd_one_scan": gold_usd_one_scan,
    "dedup_transactions": dedup_transactions,
    # lake
    "scan_silver": scan_silver,
    "scan_gold": scan_gold,
    "gold_views": gold_views,
    "gold_roundtrip": gold_roundtrip,
    "csv_export_country": _csv(G.COUNTRY),
    "csv_export_products": _csv(G.PRODUCTS),
    "csv_export_store": _csv(G.STORE),
    # streaming
    "stream_bronze": stream_bronze,
    "stream_restart": stream_restart,
    "stream_tail": stream_tail,
    "stream_silver": stream_silver,
    "stream_gold_country": _stream_gold(G.COUNTRY),
    "stream_gold_products": _stream_gold(G.PRODUCTS),
    "stream_gold_store": _stream_gold(G.STORE),
    "stream_gold_all": stream_gold_all,
    "stream_rejects": stream_rejects,
    "stream_dedup": stream_dedup,
    "stream_dedup_late": stream_dedup_late,
    "stream_gold_deltas": stream_gold_deltas,
    "publish_ordered": publish_ordered,
    "dq_unparsed_fields": dq_unparsed_fields,
    "fraud_curve": fraud_curve,
    "gold_distinct_sketches": gold_distinct_sketches,
    "stream_split": stream_split,
    "gold_incremental": gold_incremental,
    "compacted_silver": compacted_silver,
    "store_revenue": store_revenue,
    "stream_dedup_batches": stream_dedup_batches,
    # silver, gold, reports
    "silver_clean": silver_clean,
    "silver_row_count": silver_row_count,
    "gold_revenue_by_country": _gold(G.COUNTRY),
    "gold_top_products": _gold(G.PRODUCTS),
    "gold_revenue_by_store": _gold(G.STORE),
    "gold_tables_one_scan": gold_tables_one_scan,
    "raw_revenue_by_country": _raw(G.COUNTRY),
    "raw_top_products": _raw(G.PRODUCTS),
    "raw_revenue_by_store": _raw(G.STORE),
    "report_revenue_by_country": report_revenue_by_country,
    "report_top10_products": report_top10_products,
    "report_top_stores": report_top_stores,
    "kpi_total_transactions": kpi_total_transactions,
    "kpi_total_countries": kpi_total_countries,
    "kpi_country_groups": kpi_country_groups,
    "kpi_best_product": kpi_best_product,
    "kpi_busiest_store": kpi_busiest_store,
    "kpi_row": kpi_row,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
