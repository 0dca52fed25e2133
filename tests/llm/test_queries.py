"""Registered queries against their SQL, and the pipeline against its parts."""

import random
import re

import pytest
from oracle_harness import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from tillwright.llm.oracle import oracle_sql
from tillwright.llm.queries import queries

DIR = "/root/testdata/sf0.001"


def test_thirteen_queries():
    assert sorted({int(re.match(r"op(\d+)_", n)[1]) for n in queries()}) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, name):
    result = compare(spark, DIR, name, queries()[name], oracle_sql()[name], duck(DIR))
    assert result["status"] == "match", result


def test_native_queries_run_no_python(spark):
    for name in ("op2_url_filters", "op4_quality_rules"):
        plan = queries()[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|MapInArrow|ArrowEval", plan)


def test_pipeline_stages(spark, tmp_path):
    """Each stage keeps what its operator says, over an own table with hard rows."""
    good = [" ".join(f"w{random.Random(i * 1000 + k).randrange(997)}" for k in range(80)) for i in range(20)]
    item = " ".join(f"bench{k}" for k in range(15))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(good)]
    rows += [(100, good[3] + " more", "en", "s", 1), (101, good[4], "en", "s", 1), (4, good[4], "en", "s", 1), (102, None, None, None, None), (103, "short", "en", "s", 5)]
    rows += [(104, good[5][:200] + " " + " ".join(f"q{k}" for k in range(60)) + " " + item, "en", "s", 1)]
    rows += [(105, " ".join(f"k{k}" for k in range(70)) + " password=hunter22x", "en", "s", 1), (None, " ".join(f"z{k}" for k in range(70)), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"kept": F.lit("clash"), "spans": F.lit(1), "n_hit": F.lit("x")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        columns = df.columns
        df = stage(spark, df, str(tmp_path))
        seen.append(sorted((r["doc_id"] for r in df.collect()), key=str))
        assert name == "bpe" or df.columns == columns
        if name == "secret_scans":
            masked = {r["doc_id"]: r for r in df.collect()}
            assert masked[105]["text"].endswith("<assign>") and masked[105]["n_chars"] == len(masked[105]["text"]) and masked[105]["kept"] == "clash"
    one = sorted([*range(20), 104, 105, None], key=str)
    assert seen[0] == sorted([*range(20), 4, 100, 101, 104, 105, None], key=str)
    assert seen[1] == one and seen[2] == sorted(set(one) - {104}, key=str) == seen[3] == seen[4]


def test_near_dedup_judges_each_row_by_its_text(spark):
    """Ids that repeat: a near copy goes, another text under the same id stays, two near-equal texts of one id leave one."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (5, a + " more"), (5, b), (7, c), (7, c + " more"), (7, c.upper()), (None, a + " again")]
    docs = spark.createDataFrame([(i, t, "keep") for i, t in rows], "doc_id long, text string, _set string")
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in got) == [1, 5, 7] and {r["text"] for r in got} >= {a, b} and {r["_set"] for r in got} == {"keep"}


def test_pipeline_over_given_and_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, DIR).count() > 50
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
