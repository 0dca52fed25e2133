"""Run registered queries with Spark's event log in a scratch folder and print
per-stage wall time (no UI, no server).

usage: python scripts/profile_query.py SF_DIR NAME [NAME ...]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _events(log_dir):
    import zstandard

    for f in sorted(glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*.zstd")):
        raw = open(f, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main(argv):
    sf_dir, names = argv[1], argv[2:]
    log_dir = tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    os.environ.setdefault("TILLWRIGHT_DRIVER_MEMORY", "8g")
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tillwright.queries import queries

    qs = queries()
    for name in names:
        for attempt in range(3):
            t0 = time.perf_counter()
            df = qs[name](spark, sf_dir)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            print(f"{name} run {attempt}: build {t1 - t0:.3f}s execute {time.perf_counter() - t1:.3f}s", flush=True)
    spark.stop()
    tasks: dict[int, dict] = {}
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m, agg = e["Task Metrics"], tasks.setdefault(e["Stage ID"], {"run": 0, "cpu": 0, "gc": 0, "rows": 0, "shw": 0})
            agg["run"] += m["Executor Run Time"]
            agg["cpu"] += m["Executor CPU Time"] // 1_000_000
            agg["gc"] += m["JVM GC Time"]
            agg["rows"] += m["Input Metrics"]["Records Read"] + m["Shuffle Read Metrics"]["Total Records Read"]
            agg["shw"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"]
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            ms = si["Completion Time"] - si["Submission Time"]
            if ms >= 100:
                a = tasks.get(si["Stage ID"], {})
                print(
                    f"  stage {si['Stage ID']:4d} tasks {si['Number of Tasks']:3d} wall {ms:6d} ms"
                    f"  run {a.get('run', 0):6d} cpu {a.get('cpu', 0):6d} gc {a.get('gc', 0):5d} ms"
                    f"  rows in {a.get('rows', 0):8d}  shuffle out {a.get('shw', 0) // 1024:7d} KiB"
                )


if __name__ == "__main__":
    main(sys.argv)
