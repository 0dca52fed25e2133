"""Folders and files of ours, on whatever file system they lie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import FREED_SHUFFLES, session_settings

# Rows per Parquet file in layer writes (bounds file size at any scale).
MAX_RECORDS_PER_FILE = 5_000_000


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of ours."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def children(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(path, seconds since the epoch of the last change) of what lies in a folder; nothing if there is none."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return [(s.getPath().toString(), s.getModificationTime() / 1000) for s in fs.listStatus(where)]


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as written to ``path``, where it lies without the shuffle files it came from."""
    with session_settings(df.sparkSession, FREED_SHUFFLES):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
