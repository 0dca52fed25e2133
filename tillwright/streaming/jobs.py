"""Structured Streaming jobs over the event topic.

The transformations are the batch operators applied to a streaming frame;
only the sinks differ. Every query has a checkpoint, so a restart resumes
where the last committed micro-batch ended and the file sink's commit log
keeps a replayed batch from adding rows twice.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import FREED_SHUFFLES, session_settings
from ..operators import clean as C
from ..operators import gold as G
from ..functions.once import computed_once
from ..operators.parse import parse_events, with_event_time, with_processed_time
from ..plans import batches, idindex
from ..schemas import GOLD_DELTA_SCHEMA

DEFAULT_TRIGGER = "30 seconds"
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
# State with a row for each id, where the session says nothing: in RocksDB, not on the executors' heap, its memory
# bounded for all state of an executor; a micro-batch commits its changes, not all files.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKSDB}.boundedMemoryUsage": "true",
    f"{ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{ROCKSDB}.trackTotalNumberOfRows": "false",
}
# Live gold keeps every version this long, so that a reader may hold one.
RETAIN_S = 3600.0


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    if interval:
        return writer.trigger(processingTime=interval)
    return writer


def _start(writer, rows: DataFrame, available_now: bool, interval: str | None, defaults: dict[str, str] | None = None) -> StreamingQuery:
    """Start the stream of ``rows``; the shuffle files of a micro-batch go when it ends. ``defaults`` hold where the session sets nothing."""
    spark = rows.sparkSession
    unset = {k: v for k, v in (defaults or {}).items() if spark.conf.get(k, None) in (None, "")}
    with session_settings(spark, {**FREED_SHUFFLES, **unset}):
        return _trigger(writer, available_now, interval).start()


def bronze_stream(messages: DataFrame, full: bool = False) -> DataFrame:
    """Topic -> parsed rows. Parity mode keeps 9 fields; ``full`` keeps all 18
    plus the raw JSON (nothing is lost, malformed text included)."""
    return parse_events(messages, full=full, keep_raw=full)


def silver_stream(messages: DataFrame, check_finite: bool = True) -> DataFrame:
    """Topic -> silver, parsing once (silver is derived from the parsed bronze frame)."""
    return C.silver(parse_events(messages), check_finite=check_finite)


def rejects_stream(messages: DataFrame, check_finite: bool = True) -> DataFrame:
    """Topic -> the rows silver drops, each with the first rule it fails. A
    query of its own beside silver, so that each sink keeps its commit log and
    neither loses nor repeats rows after a restart."""
    return C.rejects(parse_events(messages), check_finite=check_finite)


def split_stream(messages: DataFrame, check_finite: bool = True) -> DataFrame:
    """Topic -> silver and rejects in one frame, parsed once: ``dataset`` says
    which, ``reject_reason`` why."""
    rows = with_processed_time(with_event_time(parse_events(messages)))
    reason = C.reject_reason(check_finite)
    rows = computed_once(rows, "reject_reason", reason)
    return rows.withColumn(batches.DATASET, F.when(F.col("reject_reason").isNull(), F.lit("silver")).otherwise(F.lit("rejects")))


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query: the same after every restart, another one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def start_batch_sink(
    tagged: DataFrame, root: str, checkpoint: str, available_now: bool = False, interval: str | None = None
) -> StreamingQuery:
    """Append every micro-batch of ``tagged`` (rows with ``dataset``) to the batch
    table at ``root``: one write and one commit for all its data sets. A
    micro-batch that is run again after a failure adds its rows once."""

    def add(batch: DataFrame, batch_id: int) -> None:
        batches.append(batch, root, checkpoint_id(batch.sparkSession, checkpoint), batch_id)

    writer = tagged.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(add)
    return _start(writer, tagged, available_now, interval)


def start_file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = ("country",),
    available_now: bool = False,
    interval: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append to a Parquet folder (bronze / silver) with a checkpoint."""
    writer = (
        df.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer, df, available_now, interval, STATE_ON_DISK)


def start_console(df: DataFrame, checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Tail to the console, untruncated."""
    writer = df.writeStream.outputMode("append").format("console").option("truncate", False)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _start(writer, df, available_now, None)


def live_gold(silver: DataFrame, name: str) -> DataFrame:
    """Running gold aggregate (state: one row per group)."""
    return G.gold_table(silver, name, sort=False)


def _commit_version(batch: DataFrame, gold_root: str, name: str, batch_id: int) -> None:
    from ..plans.lake import publish_table

    publish_table(batch, gold_root, name, f"{batch_id:012d}-{uuid.uuid4().hex[:8]}", RETAIN_S)


def start_live_gold(
    silver: DataFrame,
    name: str,
    gold_root: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Refresh one gold table on every trigger: ``complete`` output is written
    to a new version folder, then committed in the manifest that readers follow."""
    writer = (
        live_gold(silver, name)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: _commit_version(batch, gold_root, name, batch_id))
    )
    return _start(writer, silver, available_now, interval)


def start_live_gold_all(
    silver: DataFrame,
    gold_root: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """All three gold tables from ONE streaming aggregation (grouping sets):
    one read of the topic and one state store instead of three. Every
    trigger publishes a complete new version of each table."""
    from ..plans.lake import publish_tagged

    writer = (
        G.gold_all(silver)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(
            lambda batch, batch_id: publish_tagged(batch, gold_root, f"{batch_id:012d}-{uuid.uuid4().hex[:8]}", retain_s=RETAIN_S)
        )
    )
    return _start(writer, silver, available_now, interval)


def start_live_gold_deltas(
    silver: DataFrame,
    root: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """All three gold tables, written as changes: ``update`` output holds only the
    groups that a micro-batch changed, and those are appended to the batch
    table at ``root``. :func:`live_gold_now` takes the last row of each group."""

    def add(batch: DataFrame, batch_id: int) -> None:
        changed = batch.withColumnRenamed("gold_table", batches.DATASET)
        batches.append(changed, root, checkpoint_id(batch.sparkSession, checkpoint), batch_id, ())

    writer = G.gold_all(silver).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(add)
    return _start(writer, silver, available_now, interval)


def _newest(rows: DataFrame) -> DataFrame:
    """The last row of each group of each gold table."""
    keys = [batches.DATASET, *G.PARTIAL_KEYS]
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), batches.BATCH).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def live_gold_now(spark: SparkSession, root: str) -> DataFrame:
    """The tagged gold tables as of the last committed micro-batch."""
    rows = _newest(batches.read(spark, root, GOLD_DELTA_SCHEMA))
    return rows.drop(batches.BATCH).withColumnRenamed(batches.DATASET, "gold_table")


def compact_live_gold(spark: SparkSession, root: str) -> str | None:
    """Merge the changes written so far into one row per group."""
    return batches.compact(spark, root, GOLD_DELTA_SCHEMA, tuple(G.PARTIAL_KEYS), (), reduced=_newest)


def dedup_stream(typed: DataFrame, delay: str = "1 hour", key: str = "transaction_id") -> DataFrame:
    """Drop re-sent events: an id's state lives for ``delay`` after it arrived.

    The watermark runs on arrival time, so no event is ever late, however old
    its own time is: a store that was offline for days loses nothing, and
    events without a time need no special case. Rows without an id are dropped.
    """
    return (
        typed.filter(F.col(key).isNotNull())
        .withColumn("_arrived", F.current_timestamp())
        .withWatermark("_arrived", delay)
        .dropDuplicatesWithinWatermark([key])
        .drop("_arrived")
    )


def typed_stream(messages: DataFrame) -> DataFrame:
    """Parsed rows with ``event_time`` as a timestamp (for watermarks)."""
    return with_event_time(parse_events(messages))


def start_dedup_index(
    typed: DataFrame, root: str, checkpoint: str, available_now: bool = False, interval: str | None = None
) -> StreamingQuery:
    """Keep one event per id in the batch table at ``root``, however late a copy
    comes: each micro-batch is held against all ids stored so far."""

    def add(batch: DataFrame, batch_id: int) -> None:
        idindex.append_new(batch, root, checkpoint_id(batch.sparkSession, checkpoint), batch_id)

    writer = typed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(add)
    return _start(writer, typed, available_now, interval)


def run_until_done(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query and surface its failure, if any."""
    query.awaitTermination(timeout_s)
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query


def run_all_until_done(queries: list[StreamingQuery]) -> None:
    """Wait for several queries; if one fails, the others are stopped and the failure is raised."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                run_until_done(q, 1)
    except (RuntimeError, StreamingQueryException) as e:
        for q in queries:
            q.stop()
        raise RuntimeError(f"streaming query failed: {e}") from e
    for q in queries:
        run_until_done(q)
