"""HTML extraction: blocks, held-out pages, unseen layouts, Viterbi against enumeration."""

import html
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.llm import htmlcrf

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return htmlcrf.labelled_pages(spark.read.parquet(f"{DIR}/pages.parquet"), spark.read.parquet(f"{DIR}/documents.parquet"), 120)


@pytest.fixture(scope="module")
def field(labelled):
    return htmlcrf.trained(labelled)


def article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())


def test_held_out_pages(spark, labelled, field):
    seen = {h for h, _ in labelled}
    pages = spark.read.parquet(f"{DIR}/pages.parquet").withColumn("text", F.lit("clash")).repartition(4)
    got = htmlcrf.extracted(pages, field).collect()
    held_out = [r for r in got if r["html"] not in seen]
    assert len(held_out) > 100
    assert all(r["text"] == article(r["html"]) and r["n_chars"] == len(r["text"]) for r in held_out)


def test_unseen_layouts(field):
    rng = random.Random(99)
    words = [f"word{i}" for i in range(300)]
    right = total = 0
    for _ in range(60):
        body = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 50))) + "." for _ in range(rng.randint(2, 9))]
        found, labels = htmlcrf.laid_out(body, words, rng)
        right += sum(a == b for a, b in zip(field.decode(found), labels, strict=True))
        total += len(labels)
    assert right / total > 0.97


def test_blocks_of_odd_markup():
    page = (
        "<!DOCTYPE html><!-- <p>no</p> --><head><title>no</title><style>p{}</style></head><p>a &amp; <b>b</b>c<p>d\n  e<br>f"
        "<script>if (a < b) '</p>'</script><div hidden>no</div><ul><li>g<li>h &#233; &lt;i&gt;</ul></nope><p>x < y<p>&nbsp;</p>tail<select><option>no</select>"
    )
    assert [b.text for b in htmlcrf.blocks(page)] == ["a & bc", "d e", "f", "g", "h é <i>", "x < y", "tail"]
    assert htmlcrf.blocks("") == [] and htmlcrf.blocks("<<<>>") != None  # noqa: E711
    assert len(htmlcrf.blocks("<div>" * 3000 + "deep" + "<p>x" * 3000)) == 3001
    htmlcrf.blocks("<a title='" + "<" * 20000)


STORY = ["The valley lies far from any road, and few have seen it.", "In spring the river rises, and the meadows are full of flowers.", "Nobody knows who built the old bridge over the gorge."]


@pytest.mark.parametrize(
    "page",
    [
        "<form><article>{}</article></form>",
        "<form action=/x><div class=content>{}</div></form>",
        '<article title="the hidden valley">{}</article>',
        '<article data-x="display:none">{}</article>',
        '<article><div class="text hidden md">{}</div></article>',
        "<article title='class=menu hidden'>{}</article>",
    ],
)
def test_articles_that_no_attribute_value_or_form_may_hide(field, page):
    whole = f"<html><body><nav><ul><li><a href=/>menu</a></li></ul></nav>{page.format(''.join(f'<p>{p}</p>' for p in STORY))}<footer>&copy; us</footer></body></html>"
    assert field.extract(whole) == " ".join(STORY)


def test_formulas_stay_and_hidden_elements_and_other_forms_go(field):
    page = (
        f"<html><body><article><p>{STORY[0]}</p><p>The energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> is <svg><text>drawn</text></svg> here, says the sign.</p><p>{STORY[1]}</p>"
        f"<p hidden>no</p><p style='color:red; display : none'>no</p><p>{STORY[2]}</p></article>"
        '<form action="/go"><label>Search</label><input name="q"><p>Type a word and press the button.</p><button>no</button></form></body></html>'
    )
    assert field.extract(page) == f"{STORY[0]} The energy E=m is drawn here, says the sign. {STORY[1]} {STORY[2]}"


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(1)
    for _ in range(30):
        field = htmlcrf.Field(rng.normal(size=htmlcrf.FEATURES), rng.normal(size=(2, 2)), rng.normal(size=2))
        page = [htmlcrf.Block(f"block {i}" * (i + 1), frozenset([f"t:{i % 3}"]), "p", 0.0) for i in range(6)]
        scores = field._scores(page)

        def value(labels):
            return field.start[labels[0]] + sum(field.moves[a, b] for a, b in itertools.pairwise(labels)) + sum(s for s, y in zip(scores, labels, strict=True) if y)

        assert field.decode(page) == list(max(itertools.product([0, 1], repeat=6), key=value))


def test_nulls_empty_and_repeated_rows(spark, field):
    long = "<article>" + "<p>" + "long text " * 20000 + "</p></article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<nav><a>menu</a></nav>"), (3, "u", long), (3, "u", long)]
    got = htmlcrf.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"), field).collect()
    assert sorted(((r["page_id"] or 0, r["n_chars"]) for r in got)) == [(0, 0), (1, 0), (2, 0), (3, 199999), (3, 199999)]
    assert htmlcrf.extracted(spark.createDataFrame([], "page_id long, url string, html string"), field).count() == 0


def test_without_labelled_pages(spark):
    pages = spark.createDataFrame([(1, "x", "<p>a</p>")], "page_id long, url string, html string")
    assert htmlcrf.labelled_pages(pages, spark.createDataFrame([], "doc_id long, text string")) == []
    field = htmlcrf.trained([])
    assert field.extract("<nav><a href=/>menu</a></nav><article><p>The story is long and good.</p></article><footer>&copy; us</footer>") == "The story is long and good."
