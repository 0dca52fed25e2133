"""Source divergence against brute force with Python integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tillwright.llm import divergence

TERM = "[^\x00-\x40\x5b-\x60\x7b-\x7f]+"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(TERM, (text or "").translate(UPPER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: [t for t, n in docs[lang].items() if n >= 3] for lang, _ in groups}
    total = {g: sum(counts[g][t] for t in kept[g[0]]) for g in groups}

    def share(count, n, lang):
        return 1 + 1_000_000_000 * (count + 1) // (n + len(kept[lang]))

    out = set()
    for lang, source in groups:
        others = sorted(s for x, s in groups if x == lang and s != source)
        values = []
        for s in others:
            value = 0
            for t in kept[lang]:
                p, q = share(counts[lang, source][t], total[lang, source], lang), share(counts[lang, s][t], total[lang, s], lang)
                value += (p - q) ** 2 // q
            values.append((value, s))
        values.sort(key=lambda x: (-x[0], x[1].encode()))
        out |= {(lang, source, "pair", s, v, k) for k, (v, s) in enumerate(values, 1)}
        whole = sum(n for g, n in total.items() if g[0] == lang)
        values = []
        for t in kept[lang]:
            c = counts[lang, source][t]
            p, q = share(c, total[lang, source], lang), share(sum(counts[g][t] for g in groups if g[0] == lang), whole, lang)
            if c and p > q:
                values.append(((p - q) ** 2 // q, t))
        values.sort(key=lambda x: (-x[0], x[1].encode()))
        out |= {(lang, source, "term", t, v, k) for k, (v, t) in enumerate(values[:200], 1)}
    return out


def rows_of(seed):
    rng = random.Random(seed)
    words = ["the", "The", "über", "É", "é", "x1y", "日本", "a_b", "𝒜", "B c"] + [f"{a}{b}" for a in "klmnopqrs" for b in "tuvwxyz" * 4]
    rows = []
    for _ in range(120):
        source = rng.choice(["s1", "s2", "s2", "s2", "z", "ä", "", None])
        text = rng.choice(["", "\n"]).join(rng.choice(words) + rng.choice([" ", "7", "-", ","]) for _ in range(rng.choice([0, 3, 40, 300])))
        rows.append((rng.choice([text, text, text, None]), rng.choice(["en", "en", "de", None]), source))
    return rows + [("lonely words here", "xx", "one"), ("lonely words here", "xx", "two"), (None, "yy", "only")]


def test_audit_equals_brute_force(spark):
    rows = rows_of(11)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"n": F.lit("clash"), "term": F.lit(1)}).repartition(4)
    got = {tuple(r) for r in divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == brute(rows)


def test_small_batches_and_flushes_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "COMBINE", 50)
    rows = rows_of(12)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    got = {tuple(r) for r in divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == brute(rows)


def test_terms_do_not_run_over_texts():
    data = np.frombuffer("abCD1é".encode(), np.uint8)
    terms, text = divergence.terms_of(data, np.array([0, 2, 2, len(data)]))
    assert [t.as_py().decode() for t in terms] == ["ab", "cd", "é"] and text.tolist() == [0, 2, 2]


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**15, 3 * 10**15, 10**8)], "c long, n long, v long")
    got = df.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert got == 1 + 10**9 * (10**15 + 1) // (3 * 10**15 + 10**8)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
