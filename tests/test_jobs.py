"""The command-line jobs, end to end on sf0.001 (same session, in process)."""

from __future__ import annotations

from conftest import SF_SMALL
from tillwright import jobs
from tillwright.config import scratch_path
from tillwright.operators import gold as G
from tillwright.plans import lake as L
from tillwright.schemas import GOLD_SCHEMAS


def test_publish_bronze_silver_gold_export(spark):
    root = scratch_path(spark, "t-jobs")
    topic = f"{root}/topic"
    jobs.main(["publish", "--sf-dir", SF_SMALL, "--topic", topic])
    jobs.main(["bronze", "--topic", topic, "--out", f"{root}/bronze", "--checkpoint", f"{root}/ck-b", "--once"])
    jobs.main(["silver", "--topic", topic, "--out", f"{root}/silver", "--checkpoint", f"{root}/ck-s", "--once"])
    jobs.main(["gold", "--silver", f"{root}/silver", "--gold-root", f"{root}/gold"])
    jobs.main(["export", "--gold-root", f"{root}/gold", "--out", f"{root}/csv"])

    assert spark.read.parquet(f"{root}/bronze").count() == 6000
    assert L.read_silver(spark, f"{root}/silver").count() == 5584
    country = L.read_csv(spark, f"{root}/csv/{G.COUNTRY}", GOLD_SCHEMAS[G.COUNTRY])
    assert sum(r.total_transactions for r in country.collect()) == 5584
    text = spark.read.text(f"{root}/csv/{G.COUNTRY}").collect()
    assert text[0].value == "country,currency,total_revenue,total_transactions"
    assert "E" not in text[1].value.split(",")[2]  # plain decimals, no exponent
    counts = [int(r.value.split(",")[3]) for r in text[1:]]
    assert counts == sorted(counts, reverse=True)


def test_small_gold_is_one_sorted_file(spark):
    import glob

    from tillwright.operators import clean as C
    from tillwright.sources.ledger import bronze_rows

    root = scratch_path(spark, "t-gold-sorted")
    L.publish_gold(C.silver(bronze_rows(spark, SF_SMALL), stamp=False), root)
    path = L.current_gold_path(spark, root, G.STORE)
    files = glob.glob(path.replace("file:", "") + "/*.parquet")
    assert len(files) == 1
    revenue = [r.total_revenue for r in spark.read.parquet(path).collect()]
    assert revenue == sorted(revenue, reverse=True)


def test_usd_gold_scans_the_topic_once(spark):
    from tillwright.operators import clean as C
    from tillwright.operators import enrich as E
    from tillwright.sources.dims import fx_dim
    from tillwright.sources.ledger import bronze_rows

    root = scratch_path(spark, "t-usd")
    jobs.main(["publish", "--sf-dir", SF_SMALL, "--topic", f"{root}/topic"])
    jobs.main(["usd-gold", "--topic", f"{root}/topic", "--out", f"{root}/usd"])
    silver = C.silver(bronze_rows(spark, SF_SMALL), stamp=False)
    for by in ("country", "store", "product"):
        want = E.usd_revenue(silver, fx_dim(spark), by)
        got = spark.read.parquet(f"{root}/usd/{by}")
        assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
