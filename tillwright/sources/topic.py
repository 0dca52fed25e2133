"""The event topic: keyed JSON messages, from Kafka or from a folder of files.

A message is ``(key = store_id, value = event JSON)``. With Kafka the
connector jar must be on the classpath; a folder of Parquet files with
``key`` / ``value`` columns offers the same contract for tests and replays.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FREED_SHUFFLES, session_settings
from ..schemas import EVENT_FIELDS, MESSAGE_SCHEMA
from ..operators.sequence import numbered
from .ledger import as_produced


def to_messages(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Events (18 fields, ``event_time`` as timestamp) -> keyed JSON messages.

    The JSON carries the producer's field order; null fields are left out.
    Rows are not shuffled by key: a Kafka sink routes each key to one topic
    partition itself. Within each task a store's events are sent in event
    time order, so the topic keeps per-store order for every writer task
    without ever gathering a hot store into a single task. ``ordered=False``
    skips that local sort for consumers that do not publish.
    """
    produced = as_produced(events)
    messages = produced.select(
        F.col("store_id").alias("key"),
        F.to_json(F.struct(*[n for n, _ in EVENT_FIELDS])).alias("value"),
        F.col("event_time").alias("_t"),
    )
    if ordered:
        messages = messages.sortWithinPartitions("key", "_t")
    return messages.drop("_t")


def ordered_messages(events: DataFrame) -> DataFrame:
    """Messages with ``seq``, the gapless number of the event within its store in
    time order, so that a consumer can put a store's events in order (and see a
    gap) whichever tasks and partitions they came through.

    Events of one store and time are numbered by their other fields.
    """
    produced = as_produced(events)
    fields = [n for n, _ in EVENT_FIELDS]
    order = ["event_time", "transaction_id", *[n for n in fields if n not in ("event_time", "transaction_id", "store_id")]]
    return numbered(produced, "store_id", order).select(
        F.col("store_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"), "seq"
    )


def with_sequence_header(messages: DataFrame, fmt: str = "files") -> DataFrame:
    """Messages as a topic takes them: with Kafka ``seq`` travels as a header, a file topic keeps the column."""
    if fmt != "kafka":
        return messages
    header = F.struct(F.lit("seq").alias("key"), F.col("seq").cast("string").cast("binary").alias("value"))
    return messages.select("key", "value", F.array(header).alias("headers"))


def resent(df: DataFrame, copies: int = 2, number: str | None = None) -> DataFrame:
    """Every row delivered ``copies`` times (a producer retrying every send),
    from one pass over ``df``; ``number`` names a column for the number of the copy."""
    sent = df.withColumn(number or "_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return sent if number else sent.drop("_copy")


def write_topic(messages: DataFrame, target: str, fmt: str = "files", options: dict | None = None) -> None:
    """Publish messages (batch). ``fmt="kafka"`` needs ``options`` with
    ``kafka.bootstrap.servers`` and ``topic``; ``"files"`` appends Parquet.
    The shuffle files of ``messages`` go when they are written."""
    with session_settings(messages.sparkSession, FREED_SHUFFLES):
        if fmt == "kafka":
            messages.write.format("kafka").options(**(options or {})).save()
        else:
            messages.write.mode("append").option("compression", "zstd").parquet(target)


def read_events(
    spark: SparkSession,
    source: str,
    fmt: str = "files",
    starting: str = "earliest",
    options: dict | None = None,
    max_files_per_trigger: int | None = None,
    since: dt.datetime | None = None,
) -> DataFrame:
    """Streaming read of the topic as ``key`` / ``value`` text.

    ``starting`` maps to ``startingOffsets`` for Kafka. A file folder has no
    offsets: there ``latest`` reads the files written at or after ``since``
    (default: now). A query that is restarted on its checkpoint must pass the
    same ``since`` again.
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("subscribe", source)
            .option("startingOffsets", starting)
            .options(**(options or {}))
        )
        return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if starting != "latest":
        return reader.parquet(source)
    after = F.lit(since or dt.datetime.now(dt.timezone.utc))
    return reader.parquet(source).filter(F.col("_metadata.file_modification_time") >= after).select("key", "value")


def read_events_batch(spark: SparkSession, source: str, fmt: str = "files", options: dict | None = None) -> DataFrame:
    """Batch read of the whole topic (replays, backfills)."""
    if fmt == "kafka":
        return (
            spark.read.format("kafka")
            .option("subscribe", source)
            .options(**(options or {}))
            .load()
            .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
        )
    return spark.read.schema(MESSAGE_SCHEMA).parquet(source)
