"""Shared helpers: table reads, staged tables, Arrow batches as byte buffers, exact ranks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path

#: Rows in one Arrow batch. Documents may be long, so batches hold few of them.
ARROW_ROWS = 256
#: Bytes of text that one numpy pass works on (a longer single text is a pass of its own).
PASS_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; Catalyst prunes its columns."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_batches(df: DataFrame, function, schema, rows: int = ARROW_ROWS) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(function, schema)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once,
    survives lost executors, cuts the lineage."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_at(df: DataFrame, name: str, **options) -> tuple[DataFrame, str]:
    """Like :func:`staged`, with options of the writer; also gives the path, for :func:`dropped`."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def shared_table(uri: str) -> pa.Table:
    """A Parquet file in the shared folder, read inside a task. Spark's ``s3a`` is ``s3`` to pyarrow."""
    scheme, mark, rest = uri.partition("://")
    files, path = fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + mark + rest)
    return pq.read_table(path, filesystem=files)


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a staged table of ours that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column end to end, and offsets of length n + 1. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def passes(batches: Iterator[pa.RecordBatch], text: str, most: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of column ``text`` each, never cutting a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffer_of(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def ranked(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "ranked", few_groups: bool = True) -> DataFrame:
    """Adds ``rank``: gapless from 0 in the order of the columns ``order`` within ``group``.

    ``few_groups``: the number of groups does not grow with the data, so the
    counts (at most one for each partition and each group) may be broadcast.

    Rows are range-partitioned on group and order together, so neither a hot
    group nor a run of equal leading keys gathers in one task as long as the
    last order columns tell rows apart. Each partition numbers its own rows;
    only one count per (partition, group) meets in the small prefix sum.
    """
    spark = df.sparkSession
    keys = [*group, *order]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
    )
    laid = staged(laid, name)
    by = ["_part", *group]
    counts = laid.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = "sum(_n) OVER (" + (f"PARTITION BY {', '.join(group)} " if group else "") + "ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = counts.select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_g_{g}") for g in group],
        (F.coalesce(F.expr(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    on = laid["_part"] == offsets["_p"]
    for g in group:
        on = on & laid[g].eqNullSafe(offsets[f"_g_{g}"])
    return (
        laid.join(F.broadcast(offsets) if few_groups else offsets, on)
        .withColumn("rank", (F.col("_at") + F.col("_shift")).cast("bigint"))
        .drop("_part", "_at", "_p", "_shift", *[f"_g_{g}" for g in group])
    )


def appended(df: DataFrame, function, added: str) -> DataFrame:
    """All columns of ``df`` (those that ``added`` names anew are replaced)
    and the columns ``added`` (DDL), which ``function`` appends to each Arrow batch."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    new = _parse_datatype_string(added)
    kept = df.drop(*[f.name for f in new.fields])
    return map_batches(kept, function, StructType([*kept.schema.fields, *new.fields]))


def with_arrays(batch: pa.RecordBatch, **arrays: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays.values()], [*batch.schema.names, *arrays])
