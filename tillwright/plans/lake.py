"""Batch layer writes and reads: silver, versioned gold, CSV export.

Gold is published without ever exposing a half-written table: each run
writes new version folders, then appends one row per table to a small
manifest; readers follow the manifest's latest committed version. A failed
run leaves only unreferenced folders behind.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold as G
from ..schemas import GOLD_SCHEMAS, SILVER_READ_SCHEMA
from . import batches, manifest
from .files import MAX_RECORDS_PER_FILE, exists, remove

# Manifest entries beside the gold tables: the unrounded sums, and the number of the last batch in them.
PARTIALS = "_partials"
COUNTED = "_counted"
# Committed gold versions that stay readable; older ones are removed by a publish.
KEEP_VERSIONS = 10


def write_silver(silver: DataFrame, path: str, spread: int | None = None) -> None:
    """Append silver as Parquet partitioned by country.

    Rows are rebalanced by country: Spark splits a hot country and merges
    small ones to its advisory partition size, so the number of files follows
    the data. ``spread`` instead deals every country over that many buckets.
    """
    if spread:
        laid = silver.repartition("country", F.pmod(F.xxhash64("transaction_id"), F.lit(spread)))
    else:
        laid = silver.hint("rebalance", "country")
    laid.write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("country").parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver with an explicit schema, so ``country`` stays a string."""
    return spark.read.schema(SILVER_READ_SCHEMA).parquet(path)


def read_bronze(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def publish_gold(silver: DataFrame, gold_root: str) -> str:
    """Compute all gold tables from ONE scan of silver and publish them."""
    return publish_tagged(G.gold_all(silver), gold_root)


def publish_tagged(
    tagged_result: DataFrame,
    gold_root: str,
    version: str | None = None,
    tables: tuple[str, ...] = G.GOLD_TABLES,
    retain_s: float = 0.0,
) -> str:
    """Publish ``tables`` from one tagged result: one partitioned write.

    The result is written once (a lineage cut; a micro-batch must not be
    computed twice), then sorted so that every table is in its own order and
    written to the version's folder, with a sub-folder for each table. The
    same path serves any size: a small table comes out as one file, a large
    one as several in order. Superseded versions are removed at the end, but
    none younger than ``retain_s`` seconds: a reader may still hold it.
    """
    spark = tagged_result.sparkSession
    root = gold_root.rstrip("/")
    version = version or _version()
    stage = f"{root}/_stage/v={version}"
    tagged_result.write.parquet(stage)
    staged = spark.read.schema(tagged_result.schema).parquet(stage)
    G.sort_tagged(staged).write.partitionBy("gold_table").parquet(f"{root}/v={version}")
    manifest.commit(spark, root, [(name, version, f"{root}/v={version}/gold_table={name}") for name in tables])
    remove(spark, stage)
    expire(spark, root, retain_s=retain_s)
    return version


def publish_table(result: DataFrame, gold_root: str, name: str, version: str | None = None, retain_s: float = 0.0) -> str:
    """Publish one gold table from a result that is computed exactly once."""
    return publish_tagged(G.tagged_table(result, name), gold_root, version, (name,), retain_s)


def publish_incremental(spark: SparkSession, batches_root: str, gold_root: str, schema: T.StructType, dataset: str = "silver", retain_s: float = 0.0) -> str | None:
    """Publish gold from the batches that came since the last publish; None if there are none.

    The version keeps the unrounded sums of all batches so far, by all keys,
    and the number of the last batch counted. The next publish reads only rows
    beyond that number (whatever files a compaction has put them in), adds
    their sums, and cuts the gold tables from the result. Tables, sums and
    number are committed together, so a failed run counts nothing twice.
    """
    root = gold_root.rstrip("/")
    now = batches.state(spark, batches_root)
    before = manifest.current_paths(spark, root) if exists(spark, f"{root}/_manifest") else {}
    through = int(before.get(COUNTED, -1))
    if now.last <= through:
        return None
    sums = G.partials(batches.read(spark, batches_root, schema, dataset, after=through, at=now))
    if PARTIALS in before:
        sums = G.merged_partials(spark.read.schema(sums.schema).parquet(before[PARTIALS]).unionByName(sums))
    version = _version()
    kept = f"{root}/v={version}/_partials"
    sums.write.parquet(kept)
    tagged = G.gold_of_partials(spark.read.schema(sums.schema).parquet(kept))
    G.sort_tagged(tagged).write.mode("append").partitionBy("gold_table").parquet(f"{root}/v={version}")
    tables = [(name, version, f"{root}/v={version}/gold_table={name}") for name in G.GOLD_TABLES]
    manifest.commit(spark, root, [*tables, (PARTIALS, version, kept), (COUNTED, version, str(now.last))])
    expire(spark, root, retain_s=retain_s)
    return version


def expire(spark: SparkSession, gold_root: str, keep: int = KEEP_VERSIONS, retain_s: float = 0.0) -> None:
    """Remove versions beyond the newest ``keep`` that no table points to and that
    are older than ``retain_s`` seconds, and their manifest files, so that
    neither grows with the number of publishes."""
    root = gold_root.rstrip("/")
    rows = manifest.entries(spark, root)
    newest = sorted({r["version"]: r["committed_at"] for r in sorted(rows, key=lambda r: r["committed_at"])}.items(), key=lambda x: x[1])
    latest = {r["gold_table"]: r["version"] for r in sorted(rows, key=lambda r: (r["committed_at"], r["version"]))}
    horizon = max((t for _, t in newest), default=None)
    doomed = {v for v, t in newest[:-keep] if (horizon - t).total_seconds() >= retain_s} - set(latest.values())
    for version in doomed:
        remove(spark, f"{root}/v={version}")
    for file in {r["file"] for r in rows} - {r["file"] for r in rows if r["version"] not in doomed}:
        remove(spark, file)


def current_gold_path(spark: SparkSession, gold_root: str, name: str) -> str:
    """Folder of the latest committed version of one gold table."""
    return manifest.current_path(spark, gold_root, name)


def _read_at(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One table of a version; the folder of an empty table need not exist."""
    schema = GOLD_SCHEMAS[name]
    version = spark.read.schema(T.StructType([*schema.fields, T.StructField("gold_table", T.StringType())])).parquet(path.rsplit("/", 1)[0])
    return version.filter(F.col("gold_table") == name).select(*schema.fieldNames())


def read_gold(spark: SparkSession, gold_root: str, name: str) -> DataFrame:
    return _read_at(spark, current_gold_path(spark, gold_root, name), name)


def read_gold_tables(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """All current gold tables, resolved with one manifest read, so of one moment."""
    paths = manifest.current_paths(spark, gold_root)
    return {n: _read_at(spark, paths[n], n) for n in G.GOLD_TABLES}


def read_gold_globs(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """All current gold tables by glob (``<version>/<table>/*.parquet``), resolved with one manifest read."""
    paths = manifest.current_paths(spark, gold_root)
    return {n: spark.read.schema(GOLD_SCHEMAS[n]).parquet(f"{paths[n]}/*.parquet") for n in G.GOLD_TABLES}


def gold_views(spark: SparkSession, gold_root: str) -> list[str]:
    """Register the current gold tables, of one moment, as temp views of the same names."""
    for name, df in read_gold_tables(spark, gold_root).items():
        df.createOrReplaceTempView(name)
    return list(G.GOLD_TABLES)


def export_csv(
    df: DataFrame,
    path: str,
    order_by: list,
    money_columns: tuple[str, ...] = ("total_revenue", "total_revenue_usd"),
) -> None:
    """Ordered CSV with a header and comma delimiter.

    A range-partitioned sort orders rows within and across part files; Spark
    merges small exports into one part, at any size by the same plan. Money
    (already rounded to cents) is written as plain decimals.
    """
    df = df.select(
        *[F.col(c).cast("decimal(38,2)").alias(c) if c in money_columns else F.col(c) for c in df.columns]
    )
    df.orderBy(*order_by).write.mode("overwrite").option("header", True).option("delimiter", ",").csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
