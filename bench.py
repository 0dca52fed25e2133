"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (timed runs per query after one warm-up, default 3).

Besides the registered queries (each over the whole driver tables), it
the reference's shape (1 count + 3 writes + 3 previews = seven scans of
silver) against ours (one grouping-sets scan, three small writes).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tillwright.config import local_session, scratch_path  # noqa: E402
from tillwright.operators import clean as C  # noqa: E402
from tillwright.operators import gold as G  # noqa: E402
from tillwright.plans import lake as L  # noqa: E402
from tillwright.queries import queries  # noqa: E402
from tillwright.sources.ledger import bronze_rows  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "silver_clean",
    "gold_tables_one_scan",
    "gold_revenue_by_country",
    "report_top10_products",
    "kpi_row",
    "silver_rejects",
    "dq_summary",
    "fraud_scores",
    "gold_usd_by_store",
    "dedup_transactions",
    "parse_events",
    "stream_silver",
    "stream_gold_all",
]


def _sf(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def _consume(df) -> None:
    """Run the whole plan without moving rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def _time(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def _median(fn, runs: int) -> float:
    fn()  # warm-up
    return statistics.median(_time(fn) for _ in range(runs))


def reference_shape_gold(spark, silver_path: str, out_root: str) -> None:
    """The reference's batch gold: three plans, seven actions, no caching."""
    df = L.read_silver(spark, silver_path)
    df.count()
    tables = {n: G.gold_table(df, n) for n in G.GOLD_TABLES}
    for name, t in tables.items():
        t.write.mode("overwrite").parquet(f"{out_root}/{name}")
    for t in tables.values():
        t.limit(20).collect()  # .show() previews re-run the plan


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS * 2), app_name="tillwright-bench")
    qs = queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = round(_median(lambda n=name: _consume(qs[n](spark, SF_DIR)), RUNS), 3)

    # silver at rest, then gold from it: ours vs the reference's shape.
    silver_paths: list[str] = []

    def write_silver() -> None:
        silver_paths.append(scratch_path(spark, "bench-silver"))
        L.write_silver(C.silver(bronze_rows(spark, SF_DIR)), silver_paths[-1])

    times["silver_write"] = round(_median(write_silver, RUNS), 3)
    silver_path = silver_paths[-1]
    times["gold_publish_one_scan"] = round(
        _median(lambda: L.publish_gold(L.read_silver(spark, silver_path), scratch_path(spark, "bench-gold")), RUNS), 3
    )
    times["gold_reference_shape"] = round(
        _median(lambda: reference_shape_gold(spark, silver_path, scratch_path(spark, "bench-ref-gold")), RUNS), 3
    )
    headline_total = round(sum(times[n] for n in HEADLINE), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": headline_total,
                "unit": "sec",
                "queries": times,
                "sf": _sf(SF_DIR),
                "cpus": CPUS,
                "runs": RUNS,
                "gold_one_scan_speedup_vs_reference_shape": round(
                    times["gold_reference_shape"] / times["gold_publish_one_scan"], 2
                ),
                "silver_rows": L.read_silver(spark, silver_path).agg(F.count(F.lit(1))).first()[0],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
