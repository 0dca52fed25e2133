"""Command-line jobs: the engine's batch and streaming entry points.

    python -m tillwright.jobs publish   --sf-dir DIR --topic PATH [--numbered]
    python -m tillwright.jobs tail      --topic PATH [--format kafka --option k=v ...]
    python -m tillwright.jobs bronze    --topic PATH --out PATH [--full] [--once]
    python -m tillwright.jobs silver    --topic PATH --out PATH [--rejects PATH] [--reference-rules] [--once]
    python -m tillwright.jobs qa | fraud | dedup | usd-gold --topic PATH --out PATH
    python -m tillwright.jobs split     --topic PATH --out TABLE [--once]          (silver and rejects, one commit a batch)
    python -m tillwright.jobs compact   --table TABLE [--expire-hours N]
    python -m tillwright.jobs gold      --silver PATH | --table TABLE --gold-root PATH
    python -m tillwright.jobs report    --gold-root PATH
    python -m tillwright.jobs export    --gold-root PATH --out DIR
    python -m tillwright.jobs live-gold --topic PATH --gold-root PATH [--table all|NAME] [--changes] [--once]

The session comes from the cluster (``spark-submit`` / defaults); nothing
here sets a master. A stream's checkpoint defaults to a sub-folder of the
configured ``spark.checkpoint.dir`` that depends on job, topic and output only,
so the next run resumes it; if none is configured, ``--checkpoint`` is needed.
"""

from __future__ import annotations

import argparse
import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import configured_dir
from .operators import clean as C
from .operators import dedup as D
from .operators import enrich as E
from .operators import fraud as FR
from .operators import gold as G
from .operators import quality as Q
from .operators import reports as R
from .operators.parse import parse_events
from .plans import batches as B
from .plans import lake as L
from .plans.files import remove
from .schemas import PARSED_FIELDS, SPLIT_SCHEMA
from .sources.dims import fx_dim, product_dim
from .sources.ledger import ledger
from .sources.topic import ordered_messages, read_events, read_events_batch, to_messages, with_sequence_header, write_topic
from .streaming import jobs as S

# Streaming settings applied only where the session leaves them unset.
STREAMING_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def _session(name: str) -> SparkSession:
    spark = SparkSession.builder.appName(f"tillwright-{name}").getOrCreate()
    for key, value in STREAMING_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def _options(pairs: list[str] | None) -> dict:
    return dict(p.split("=", 1) for p in (pairs or []))


def _checkpoint(spark, given: str | None, *names: str) -> str:
    """``--checkpoint``, or a folder that every run of the same job finds again:
    under the configured ``spark.checkpoint.dir``, named by job, topic and output."""
    if given:
        return given
    base = configured_dir(spark)
    if not base:
        raise SystemExit("no spark.checkpoint.dir is set: pass --checkpoint, or a restart would lose or repeat events")
    name = hashlib.sha256("\n".join(names).encode()).hexdigest()[:16]
    return f"{base.rstrip('/')}/tillwright-{names[0]}-{name}"


def _print_all(df) -> None:
    """Every row, a line each, fetched partition by partition."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tillwright.jobs")
    sub = ap.add_subparsers(dest="job", required=True)

    def topic_args(p):
        p.add_argument("--topic", required=True, help="Kafka topic name or a folder of message files")
        p.add_argument("--format", default="files", choices=["files", "kafka"])
        p.add_argument("--option", action="append", help="source option k=v (e.g. kafka.bootstrap.servers=...)")
        p.add_argument("--starting", choices=["earliest", "latest"], help="default: latest for tail, else earliest")
        p.add_argument("--checkpoint")
        p.add_argument("--once", action="store_true", help="process what is there, then stop (availableNow)")
        p.add_argument("--interval", default=None, help="processing-time trigger, e.g. '30 seconds'")

    p = sub.add_parser("publish", help="publish the driver tables as keyed JSON sale events")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--topic", required=True)
    p.add_argument("--format", default="files", choices=["files", "kafka"])
    p.add_argument("--option", action="append")

    p.add_argument("--numbered", action="store_true", help="give every message its number within its store")

    topic_args(sub.add_parser("tail", help="print parsed events as they arrive"))
    p = sub.add_parser("bronze", help="topic -> bronze Parquet (partitioned by country)")
    topic_args(p)
    p.add_argument("--out", required=True)
    p.add_argument("--full", action="store_true", help="keep all 18 fields and the raw JSON")
    p = sub.add_parser("silver", help="topic -> silver Parquet (typed, cleaned)")
    topic_args(p)
    p.add_argument("--out", required=True)
    p.add_argument("--rejects", help="folder for the rows silver drops, with their reasons")
    p.add_argument("--reference-rules", action="store_true", help="the six rules only, without the checks of amounts")
    p = sub.add_parser("split", help="topic -> silver and rejects in one batch table, one parse and one commit a batch")
    topic_args(p)
    p.add_argument("--out", required=True)
    p.add_argument("--reference-rules", action="store_true")
    p = sub.add_parser("compact", help="rewrite the small files of a batch table; running readers and its stream go on")
    p.add_argument("--table", required=True)
    p.add_argument("--target-mb", type=int, default=B.TARGET_BYTES >> 20)
    p.add_argument("--expire-hours", type=float, default=24.0, help="delete what was replaced longer ago")
    p = sub.add_parser("live-gold", help="topic -> continuously refreshed gold table")
    topic_args(p)
    p.add_argument("--gold-root", required=True)
    p.add_argument("--table", default="all", choices=["all", *G.GOLD_TABLES])
    p.add_argument("--changes", action="store_true", help="write only the groups that changed, to a batch table (all three tables)")

    for job, text in (("qa", "topic -> error codes per event"), ("fraud", "topic -> fraud classes and scores"), ("dedup", "topic -> one event per id"), ("usd-gold", "topic -> revenue in USD")):
        p = sub.add_parser(job, help=text)
        p.add_argument("--topic", required=True)
        p.add_argument("--format", default="files", choices=["files", "kafka"])
        p.add_argument("--option", action="append")
        p.add_argument("--out", required=True)
        if job == "fraud":
            p.add_argument("--sf-dir", required=True, help="tables that hold the product catalogue")

    p = sub.add_parser("gold", help="silver -> the three gold tables (one scan), or only what a batch table has new")
    where = p.add_mutually_exclusive_group(required=True)
    where.add_argument("--silver", help="a silver folder, read whole")
    where.add_argument("--table", help="a batch table: only batches since the last publish are read")
    p.add_argument("--gold-root", required=True)
    p = sub.add_parser("report", help="print reports and KPIs from gold")
    p.add_argument("--gold-root", required=True)
    p = sub.add_parser("export", help="gold -> ordered CSV files")
    p.add_argument("--gold-root", required=True)
    p.add_argument("--out", required=True)

    a = ap.parse_args(argv)
    spark = _session(a.job)

    if a.job == "publish":
        opts = _options(a.option)
        if a.format == "kafka":
            opts.setdefault("topic", a.topic)
        events = ledger(spark, a.sf_dir)
        messages = with_sequence_header(ordered_messages(events), a.format) if a.numbered else to_messages(events)
        write_topic(messages, a.topic, a.format, opts)
        return

    if a.job in ("tail", "bronze", "silver", "split", "live-gold"):
        starting = a.starting or ("latest" if a.job == "tail" else "earliest")
        if starting == "latest" and a.format == "files" and a.job != "tail":
            raise SystemExit("a folder of files has no offsets: only tail can start at latest there")
        if a.job != "tail":
            out = a.gold_root if a.job == "live-gold" else a.out
            ckpt = _checkpoint(spark, a.checkpoint, a.job, a.topic, out, getattr(a, "table", "") + ("-changes" if getattr(a, "changes", False) else ""))
        messages = read_events(spark, a.topic, a.format, starting, _options(a.option))
        if a.job == "tail":
            # A tail shows what arrives while it runs; it has nothing to resume.
            S.run_until_done(S.start_console(S.bronze_stream(messages), a.checkpoint, available_now=a.once))
            return
        if a.job == "bronze":
            q = S.start_file_sink(S.bronze_stream(messages, full=a.full), a.out, ckpt, available_now=a.once, interval=a.interval)
        elif a.job == "silver":
            finite = not a.reference_rules
            q = S.start_file_sink(S.silver_stream(messages, finite), a.out, ckpt, available_now=a.once, interval=a.interval)
            if a.rejects:
                again = read_events(spark, a.topic, a.format, starting, _options(a.option))
                side = S.start_file_sink(
                    S.rejects_stream(again, finite), a.rejects, f"{ckpt}-rejects", partition_by=("reject_reason",),
                    available_now=a.once, interval=a.interval,
                )
                S.run_all_until_done([q, side])
                return
        elif a.job == "split":
            tagged = S.split_stream(messages, not a.reference_rules)
            q = S.start_batch_sink(tagged, a.out, ckpt, available_now=a.once, interval=a.interval)
        elif a.changes:
            q = S.start_live_gold_deltas(
                S.silver_stream(messages), a.gold_root, ckpt, available_now=a.once, interval=a.interval or S.DEFAULT_TRIGGER
            )
        elif a.table == "all":
            q = S.start_live_gold_all(
                S.silver_stream(messages), a.gold_root, ckpt, available_now=a.once,
                interval=a.interval or S.DEFAULT_TRIGGER,
            )
        else:
            q = S.start_live_gold(
                S.silver_stream(messages), a.table, a.gold_root, ckpt, available_now=a.once,
                interval=a.interval or S.DEFAULT_TRIGGER,
            )
        S.run_until_done(q)
        return

    if a.job in ("qa", "fraud", "dedup", "usd-gold"):
        events = parse_events(read_events_batch(spark, a.topic, a.format, _options(a.option)), full=True, keep_raw=a.job == "qa")
        if a.job == "qa":
            _print_all(Q.summary(events))
            Q.error_rows(events).write.mode("overwrite").parquet(a.out)
        elif a.job == "dedup":
            D.dedup_transactions(events).write.mode("overwrite").parquet(a.out)
        elif a.job == "fraud":
            classified = FR.classify(events, product_dim(spark, a.sf_dir), fx_dim(spark))
            classified.write.mode("overwrite").parquet(a.out)
            _print_all(FR.scores(spark.read.parquet(a.out)))
        else:
            silver = C.silver(events.select(*PARSED_FIELDS), stamp=False)
            # The topic is scanned and parsed once; the three tables are cut from the small result.
            root = a.out.rstrip("/")
            E.usd_tables(silver, fx_dim(spark)).write.mode("overwrite").parquet(f"{root}/_stage")
            tagged = spark.read.parquet(f"{root}/_stage")
            for by in ("country", "store", "product"):
                E.usd_table(tagged, by).write.mode("overwrite").parquet(f"{root}/{by}")
            remove(spark, f"{root}/_stage")
        return

    if a.job == "compact":
        path = B.compact(spark, a.table, SPLIT_SCHEMA, target_bytes=a.target_mb << 20)
        gone = B.expire(spark, a.table, a.expire_hours * 3600)
        print(f"compacted: {path or 'nothing to do'}; folders deleted: {gone}")
        return

    if a.job == "gold":
        if a.table:
            version = L.publish_incremental(spark, a.table, a.gold_root, SPLIT_SCHEMA)
        else:
            version = L.publish_gold(L.read_silver(spark, a.silver), a.gold_root)
        print(f"gold published: version {version}" if version else "gold is up to date")
        return

    tables = L.read_gold_tables(spark, a.gold_root)
    if a.job == "report":
        frames = R.dashboard_frames(tables)
        for name in ("country_bars", "top_products_bars", "store_bars"):
            print(name)
            _print_all(frames[name])
        kpis = frames["kpis"]
        _print_all(kpis.withColumn("total_transactions", F.format_number("total_transactions", 0)))
    elif a.job == "export":
        for name, df in tables.items():
            keys = [F.col(k).asc_nulls_last() for k in G.KEYS[name]]
            L.export_csv(df, f"{a.out.rstrip('/')}/{name}", [F.col("total_transactions").desc(), *keys])


if __name__ == "__main__":
    main()
