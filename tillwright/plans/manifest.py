"""Version manifest for tables that are replaced as a whole (gold).

Each publish writes a new version folder first, then appends one row per
table to ``<root>/_manifest``. An append either commits its file or leaves
nothing behind, so readers see the previous version or the new one, never
a half-written table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def commit(spark: SparkSession, root: str, entries: list[tuple[str, str, str]]) -> None:
    """Append (gold_table, version, path) rows, stamped with the commit time."""
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("gold_table"), F.lit(v).alias("version"), F.lit(p).alias("path"))
            for t, v, p in entries
        ]
    )
    (
        spark.range(1)
        .select(F.inline(rows))
        .withColumn("committed_at", F.current_timestamp())
        .coalesce(1)
        .write.mode("append")
        .parquet(f"{root.rstrip('/')}/_manifest")
    )


def entries(spark: SparkSession, root: str) -> list:
    """All rows with the file each lies in (few: superseded files are removed)."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/_manifest")
    return rows.select("*", F.col("_metadata.file_path").alias("file")).collect()


def current_path(spark: SparkSession, root: str, table: str) -> str:
    """Folder of the latest committed version of ``table``."""
    row = (
        spark.read.parquet(f"{root.rstrip('/')}/_manifest")
        .filter(F.col("gold_table") == table)
        .orderBy(F.col("committed_at").desc(), F.col("version").desc())
        .select("path")
        .first()
    )
    if row is None:
        raise FileNotFoundError(f"no committed version of {table!r} under {root}")
    return row["path"]


def current_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Latest committed folder of every table, from one read of the manifest."""
    latest = (
        spark.read.parquet(f"{root.rstrip('/')}/_manifest")
        .groupBy("gold_table")
        .agg(F.max_by("path", F.struct("committed_at", "version")).alias("path"))
        .collect()
    )
    return {r["gold_table"]: r["path"] for r in latest}
