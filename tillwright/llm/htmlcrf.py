"""HTML extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, with
the tags, classes and ids of all their ancestors. Only scripts, styles, controls
and elements with a ``hidden`` attribute or ``display: none`` are left out before the field
decides; forms, formulas and drawings are ancestors like others. A block's features are
those ancestors and properties of its text (length, share of link text,
punctuation, words of notices). The field has two labels, article and other;
Viterbi decoding picks the best label sequence, and the article's blocks are
joined.

It is trained on labelled pages: at most ``SAMPLE`` pages of the corpus whose
article is known, each as it is and once more laid out anew (other containers
and boilerplate of many kinds around and inside the article), and a fixed set
of such layouts over filler words, so that a corpus without labelled pages
works too. Training is a small driver step with a bounded sample; every page
is then decoded where it lies, in one pass without a shuffle.

Defined results: null html is an empty page; a page without article blocks has
an empty text; unclosed and stray tags are tolerated; rows repeating a
``page_id`` are extracted each from its own html; other columns are kept,
except those named like the new ones.
"""

from __future__ import annotations

import html
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, passes, with_arrays

SAMPLE = 300
FILLER_PAGES = 200
EPOCHS = 8
RATE = 0.5
PENALTY = 1e-5
FEATURES = 1 << 15
#: Ancestor sets whose scores are kept in a task; beyond, the table starts anew.
KEPT_SCORES = 100_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Scripts, controls and what is never shown: all else is for the field to judge.
HIDDEN = frozenset("script style template noscript textarea select option button iframe object canvas head title".split())
RAW = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var".split())
# Parts of formulas and drawings inside a line.
INLINE |= frozenset("math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mspace semantics svg g path circle rect line ellipse polygon polyline text tspan use".split())
# Tags that end an open element of the listed tags.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
} | {t: {"p"} for t in "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()}
BARRIER = frozenset("ul ol dl table td th article aside section main div body html blockquote nav header footer".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|[^<]++|<""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'<>]++)))?+""")
_DISPLAY_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
_NAMED = ("class", "id", "role")
# Words of notices, in lower case.
NOTICE = (
    "cookie", "subscri", "newsletter", "privacy", "copyright", "©", "all rights", "log in", "login", "sign in", "sign up", "share", "tweet",
    "advert", "sponsor", "related", "comment", "reply", "replies", "posted", "menu", "terms",
)
#: Length of a text that may be a notice.
NOTICE_CHARS = 400


class Block:
    __slots__ = ("text", "around", "parent", "linked")

    def __init__(self, text: str, around: frozenset, parent: str, linked: float):
        self.text, self.around, self.parent, self.linked = text, around, parent, linked


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, their character references decoded and white space collapsed."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []
    around: Counter = Counter()
    hidden = links = 0
    text: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        nonlocal text, linked
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                in_links = len(" ".join(html.unescape("".join(linked)).split()))
                parent = next((t for t, _, _ in reversed(stack) if t not in INLINE), "")
                out.append(Block(words, frozenset(around), parent, in_links / len(words)))
            text, linked = [], []

    def pop() -> None:
        nonlocal hidden, links
        tag, names, hides = stack.pop()
        hidden -= hides
        links -= tag == "a"
        for name in names:
            around[name] -= 1
            if not around[name]:
                del around[name]

    def pop_to(tags: set[str], barrier: frozenset) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                while len(stack) > k:
                    pop()
                return
            if stack[k][0] in barrier:
                return

    at = 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        if m[2] is None:
            piece = m[0]
            if piece[0] == "<" and len(piece) > 1:
                continue
            if not hidden:
                text.append(piece)
                if links:
                    linked.append(piece)
            continue
        tag = m[2].lower()
        if tag not in INLINE:
            flush()
        if m[1]:
            if around[f"t:{tag}"]:
                pop_to({tag}, frozenset())
            continue
        if tag in ENDS:
            pop_to(ENDS[tag], BARRIER - ENDS[tag])
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        names, hides = [f"t:{tag}"], tag in HIDDEN
        for attribute, *values in _ATTRIBUTE.findall(m[3]):
            attribute, value = attribute.lower(), "".join(values)
            if attribute in _NAMED:
                names += [f"n:{n}" for n in re.findall(r"[a-z]+", value.lower())]
            hides = hides or attribute == "hidden" or (attribute == "style" and bool(_DISPLAY_NONE.search(value)))
        stack.append((tag, tuple(names), hides))
        hidden += hides
        links += tag == "a"
        for name in names:
            around[name] += 1
    flush()
    return out


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def own_key(b: Block, first: bool) -> tuple:
    """What a block's text tells: bits of its length and words, share of links, parent, last character, notice words."""
    n, notice = len(b.text), 0
    if n < NOTICE_CHARS:
        lower = b.text.lower()
        notice = any(word in lower for word in NOTICE) * (1 + (n < 80))
    return min(10, n.bit_length()), math.ceil(b.linked * 4), b.parent, b.text[-1] in ".!?…:;\"”'", min(6, (b.text.count(" ") + 1).bit_length()), notice, first


def own_features(key: tuple) -> list[int]:
    return [_slot("bias"), *(_slot(f"own{k}:{x}") for k, x in enumerate(key))]


def around_features(around: frozenset) -> list[int]:
    return [_slot(x) for x in sorted(around)]


class Field:
    """Weights of the field: one score per feature for the label article, and transitions."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, start: np.ndarray):
        self.weights, self.moves, self.start = weights, moves, start
        self._kept: dict = {}

    def _score(self, key, slots) -> float:
        got = self._kept.get(key)
        if got is None:
            if len(self._kept) > KEPT_SCORES:
                self._kept.clear()
            got = self._kept[key] = float(self.weights[slots(key)].sum())
        return got

    def _scores(self, page: list[Block]) -> list[float]:
        return [self._score(b.around, around_features) + self._score(own_key(b, not k), own_features) for k, b in enumerate(page)]

    def decode(self, page: list[Block]) -> list[int]:
        """The most probable labels (Viterbi)."""
        if not page:
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        scores = self._scores(page)
        other, article, back = self.start[0], self.start[1] + scores[0], []
        for s in scores[1:]:
            from_o, from_a = (other + m00, article + m10), (other + m01, article + m11)
            back.append((from_o[1] > from_o[0], from_a[1] > from_a[0]))
            other, article = max(from_o), max(from_a) + s
        label = int(article > other)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]

    def extract(self, page: str) -> str:
        found = blocks(page)
        return " ".join(b.text for b, label in zip(found, self.decode(found), strict=True) if label)


def train(pages: Iterable[tuple[list[Block], list[int]]], epochs: int = EPOCHS) -> Field:
    """Maximum likelihood by stochastic gradients (forward-backward), in a fixed order."""
    data = []
    for page, labels in pages:
        if page:
            rows = [np.unique(around_features(b.around) + own_features(own_key(b, not k))) for k, b in enumerate(page)]
            data.append((np.concatenate(rows), np.cumsum([0] + [len(r) for r in rows]), np.array(labels)))
    w, moves, start = np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2)
    g_w, g_moves, g_start = np.full(FEATURES, 1.0), np.ones((2, 2)), np.ones(2)
    order = random.Random(7)
    for _ in range(epochs):
        order.shuffle(data)
        for slots, ends, y in data:
            n = len(y)
            e = np.zeros((n, 2))
            e[:, 1] = np.add.reduceat(w[slots], ends[:-1])
            alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
            alpha[0] = start + e[0]
            for i in range(1, n):
                alpha[i] = np.logaddexp(alpha[i - 1, 0] + moves[0], alpha[i - 1, 1] + moves[1]) + e[i]
            for i in range(n - 2, -1, -1):
                nxt = beta[i + 1] + e[i + 1]
                beta[i] = np.logaddexp(moves[:, 0] + nxt[0], moves[:, 1] + nxt[1])
            z = np.logaddexp(*alpha[-1])
            p = np.exp(alpha + beta - z)
            pair = np.exp(alpha[:-1, :, None] + moves + (beta[1:] + e[1:])[:, None, :] - z).sum(axis=0)
            d_moves = -pair
            np.add.at(d_moves, (y[:-1], y[1:]), 1)
            d_start = np.eye(2)[y[0]] - p[0]
            d = np.repeat(y - p[:, 1], np.diff(ends))
            touched, inverse = np.unique(slots, return_inverse=True)
            d_w = np.bincount(inverse, d) - PENALTY * w[touched]
            g_w[touched] += d_w**2
            g_moves += d_moves**2
            g_start += d_start**2
            w[touched] += RATE * d_w / np.sqrt(g_w[touched])
            moves += RATE * d_moves / np.sqrt(g_moves)
            start += RATE * d_start / np.sqrt(g_start)
    return Field(w, moves, start)


# Layouts of boilerplate: a template, {w} filled with a few words, {s} with a sentence, {l} with a list of links.
BOILERPLATE = (
    '<header class="site-header"><a href="/">{w}</a><p>{s}</p></header>', '<header><h1>{w}</h1></header>', '<nav><ul>{l}</ul></nav>',
    '<div class="menu"><ul>{l}</ul></div>', '<ul id="navigation">{l}</ul>', '<div class="breadcrumbs"><a href="/">{w}</a> &gt; <a href="/x">{w}</a></div>',
    '<aside><h3>{w}</h3><p>{s}</p></aside>', '<aside class="sidebar"><ul>{l}</ul><p>{s}</p></aside>', '<div id="sidebar"><h2>{w}</h2><p>{s}</p><ul>{l}</ul></div>',
    '<div class="ad">{s}</div>', '<div class="ads"><p>{s}</p></div>', '<div class="advert"><p>{s}</p><a href="/buy">{w}</a></div>', '<section class="sponsored"><p>{s}</p></section>',
    '<div class="banner">{s}</div>', '<div class="promo"><p>{s}</p></div>', '<div class="cookie-notice">{s} <button>OK</button></div>', '<div id="cookie-banner"><p>{s}</p></div>',
    '<div class="notice">{s}</div>', '<div role="alert" class="consent"><p>{s}</p></div>', '<div class="popup modal"><p>{s}</p></div>',
    '<form action="/go"><label>{w}</label><input name="q"><p>{s}</p><button>{w}</button></form>', '<div class="newsletter"><p>{s}</p></div>', '<div class="subscribe">{s}</div>',
    '<section class="comments"><h2>{w}</h2><div class="comment"><p>{s}</p><p>{s}</p></div><div class="comment"><p>{s}</p></div></section>',
    '<div id="comments"><p>{s}</p><ul><li>{s}</li><li>{s}</li></ul></div>', '<ol class="comment-list"><li><p>{s} {s}</p></li><li><p>{s}</p></li></ol>',
    '<div class="share"><a href="/a">{w}</a> <a href="/b">{w}</a></div>', '<div class="social"><ul>{l}</ul></div>', '<div class="related"><h3>{w}</h3><ul>{l}</ul></div>',
    '<div class="pagination"><a href="/1">1</a> <a href="/2">2</a></div>', '<div class="meta">{w}</div>', '<footer>&copy; {w}</footer>',
    '<footer class="site-footer"><p>{s}</p><ul>{l}</ul></footer>', '<div id="footer"><p>&copy; {s}</p></div>', '<div class="copyright">{w}</div>',
)
CONTAINERS = (
    "<article>{}</article>", "<article>{}</article>", "<article>{}</article>", '<article class="post">{}</article>', "<main><article>{}</article></main>", "<main>{}</main>",
    "<form><article>{}</article></form>", '<form action="/page" id="page"><div class="content">{}</div></form>',
    '<div class="content">{}</div>', '<div id="main" class="article-body">{}</div>', '<section class="story entry">{}</section>', '<div class="post"><div class="text">{}</div></div>',
)
PARAGRAPHS = ("<p>{}</p>",) * 8 + ("<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<h2>{}</h2>", "<h3>{}</h3>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>", "<pre>{}</pre>", "<p>{}<br>", "<table><tr><td>{}</td></tr></table>")


def laid_out(article: list[str], words: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A labelled page: the paragraphs in some container, with boilerplate of several kinds."""
    mark = "\x02"

    def some(n: int) -> str:
        return " ".join(rng.choice(words) for _ in range(n))

    def filled(template: str) -> str:
        return re.sub(r"\{([wsl])\}", lambda m: {
            "w": lambda: html.escape(some(rng.randint(1, 3))),
            "s": lambda: html.escape(some(rng.randint(4, 40)).capitalize() + "."),
            "l": lambda: "".join(f'<li><a href="/{k}">{html.escape(some(rng.randint(1, 3)))}</a></li>' for k in range(rng.randint(1, 7))),
        }[m[1]](), template)

    inside = []
    for k, p in enumerate(article):
        shape = rng.choice(("<h1>{}</h1>", "<p>{}</p>")) if not k else rng.choice(PARAGRAPHS)
        inside.append(shape.format(mark + html.escape(p)))
        if rng.random() < 0.05:
            inside.append(filled(rng.choice(BOILERPLATE)))
    if rng.random() < 0.2:
        inside.append(filled(rng.choice([b for b in BOILERPLATE if "comment" in b])))
    head = [filled(rng.choice(BOILERPLATE)) for _ in range(rng.randint(0, 4))]
    tail = [filled(rng.choice(BOILERPLATE)) for _ in range(rng.randint(0, 4))]
    page = "<html><body>" + "".join(head) + rng.choice(CONTAINERS).format("".join(inside)) + "".join(tail) + "</body></html>"
    found = blocks(page)
    labels = [int(b.text.startswith(mark)) for b in found]
    for b in found:
        b.text = b.text.removeprefix(mark)
    return found, labels


def aligned(page: str, text: str) -> tuple[list[Block], list[int]]:
    """Blocks of a page whose article is known: those that are lines of it, or its beginning (a heading)."""
    lines = {" ".join(line.split()) for line in text.split("\n")}
    whole = " ".join(text.split())
    found = blocks(page)
    return found, [int(b.text in lines or (len(b.text) > 8 and whole.startswith(b.text))) for b in found]


def trained(known: list[tuple[str, str]]) -> Field:
    """A field from (html, article text) of labelled pages."""
    rng = random.Random(11)
    filler = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she there".split()
    pages = []
    for page, text in known:
        found, labels = aligned(page, text)
        if any(labels):
            pages.append((found, labels))
            words = text.split() or filler
            pages.append(laid_out([b.text for b, y in zip(found, labels, strict=True) if y], words, rng))
    for _ in range(FILLER_PAGES):
        article = [" ".join(rng.choice(filler) for _ in range(rng.randint(1, 60))).capitalize() + "." for _ in range(rng.randint(1, 12))]
        pages.append(laid_out(article, filler, rng))
    return train(pages)


def labelled_pages(pages: DataFrame, documents: DataFrame, most: int = SAMPLE) -> list[tuple[str, str]]:
    """At most ``most`` pairs (html, text) of pages whose url ends in the number of a document, by smallest hashed id."""
    number = F.regexp_extract(F.coalesce("url", F.lit("")), r"/([0-9]{1,18})(?:\.html|/)?(?:[?#]|\z)", 1)
    sample = (
        pages.select("page_id", F.when(number != "", number.cast("bigint")).alias("doc_id"))
        .filter("doc_id IS NOT NULL AND page_id IS NOT NULL")
        .orderBy(F.xxhash64("page_id"), "page_id")
        .limit(most)
    )
    # Both sides of the joins are the bounded sample; the large tables are only scanned.
    texts = documents.select("doc_id", "text").join(F.broadcast(sample.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    pairs = (
        pages.select("page_id", "html").join(F.broadcast(sample), "page_id").filter("html IS NOT NULL").join(F.broadcast(texts.filter("text IS NOT NULL")), "doc_id")
    )
    return [(r["html"], r["text"]) for r in pairs.orderBy("page_id", "html", "text").limit(most).select("html", "text").collect()]


def extracted(pages: DataFrame, field: Field) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points)."""
    weights = field.weights.nonzero()[0], field.weights[field.weights.nonzero()], field.moves, field.start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros(FEATURES)
        w[weights[0]] = weights[1]
        model = Field(w, weights[2], weights[3])
        for batch in passes(batches, "html"):
            texts = [model.extract(h or "") for h in batch.column("html").to_pylist()]
            yield with_arrays(batch, text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))

    return appended(pages, run, "text string, n_chars bigint")
