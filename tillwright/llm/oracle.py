r"""DuckDB SQL of this package's queries that SQL can express.

Hash functions, compressors, trained fields, tokenizers and propagation are
not SQL: ``op3``, ``op4`` and ``op6`` to ``op10`` are tested against brute force in
``tests/llm`` instead.
"""

from __future__ import annotations

from . import urls

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT rid, doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p : p + 4], ' ')))
    WHEN len(w) > 0 THEN [len(w) || ':' || array_to_string(w, ' ')] ELSE [] END AS set FROM d
), x AS (SELECT rid, len(set) AS n, unnest(set) AS shingle FROM s),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.rid <> b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT DISTINCT a AS rid, a AS other FROM links UNION SELECT r.rid, l.b FROM reach r JOIN links l ON r.other = l.a
), c AS (SELECT r.rid, min(s.doc_id) AS component_id FROM reach r JOIN s ON r.other = s.rid GROUP BY r.rid)
SELECT s.doc_id, CAST(len(set) AS BIGINT) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id,
  coalesce(s.doc_id = coalesce(c.component_id, s.doc_id), TRUE) AS kept
FROM s LEFT JOIN c ON s.rid = c.rid
"""

_HOST = f"translate(regexp_extract(rest, '^([^/?#]*)', 1), {LOWER})"
_PATH = "regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)"
_EXTENSION = r"(\.[A-Za-z]{1,5})?"


def _rule_case(what: str) -> str:
    """The longest fitting rule, or its verdict."""
    ordered = sorted(urls.RULES, key=lambda r: -len(r[1]) - len(r[2]))
    whens = [
        f"WHEN (host = '{of}' OR ends_with(host, '.{of}')) AND starts_with(path, '{prefix}') THEN '{of + prefix if what == 'rule' else verdict}'"
        for verdict, of, prefix in ordered
    ]
    return f"CASE {' '.join(whens)} END"


OP2 = rf"""
WITH rests AS (
  SELECT page_id, coalesce(url, '') AS url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, {_HOST} AS host, {_PATH} AS path, TRY_CAST(regexp_extract(url, '/([0-9]{{1,18}})(?:\.html|/)?(?:[?#]|\z)', 1) AS BIGINT) AS doc_id FROM rests
), known AS (
  SELECT doc_id, max(CAST((quality = 0) OR (toxic = 1) AS INT)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), paths AS (
  SELECT host, path, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM p LEFT JOIN known USING (doc_id) GROUP BY host, path
), cut AS (
  SELECT *, list_transform(string_split(path, '/'), lambda s: CASE
      WHEN regexp_matches(s, '^[0-9]+{_EXTENSION}\z') THEN '*' || regexp_extract(s, '^[0-9]+{_EXTENSION}\z', 1)
      WHEN regexp_matches(s, '^[0-9a-fA-F-]{{8,}}{_EXTENSION}\z') THEN '*' || regexp_extract(s, '^[0-9a-fA-F-]{{8,}}{_EXTENSION}\z', 1)
      WHEN regexp_matches(s, '[0-9]') AND regexp_matches(s, '^[A-Za-z0-9_-]{{12,}}{_EXTENSION}\z')
        THEN '*' || regexp_extract(s, '^[A-Za-z0-9_-]{{12,}}{_EXTENSION}\z', 1)
      ELSE s END) AS g FROM paths
), nodes AS (
  SELECT host, path, n, k, i, g[i] AS segment FROM cut, unnest(range(1, len(g) + 1)) AS u(i)
), rare AS (
  SELECT host, i, segment FROM nodes WHERE NOT starts_with(segment, '*') GROUP BY host, i, segment HAVING sum(n + 1) < {urls.MIN_SUPPORT}
), pooled AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY host, i) AS members FROM rare) WHERE members > 1),
shaped AS (
  SELECT host, path, n, k, string_agg(CASE WHEN r.segment IS NULL THEN nodes.segment ELSE '*' END, '/' ORDER BY nodes.i) AS template
  FROM nodes LEFT JOIN pooled r USING (host, i, segment) GROUP BY host, path, n, k
), t AS (SELECT host, template, sum(n) AS n, sum(k) AS k FROM shaped GROUP BY host, template),
hosts AS (
  SELECT host, (sum(k) + 20::DOUBLE * (SELECT coalesce(sum(k) / greatest(sum(n), 1)::DOUBLE, 0) FROM t)) / (sum(n) + 20::DOUBLE) AS ph FROM t GROUP BY host
), sib AS (
  SELECT t.*, ph, (k + 20::DOUBLE * ph) / (n + 20::DOUBLE) AS p, regexp_extract(template, '^((?s:.*))/[^/]*/[^/]*\z', 1) AS parent,
    len(string_split(template, '/')) || regexp_extract(template, '(\*?(?:\.[A-Za-z]{{1,5}})?)\z', 1) AS shape FROM t JOIN hosts USING (host)
), gaps AS (
  SELECT *, coalesce(CAST(p - lag(p) OVER s > {urls.Z}::DOUBLE * sqrt(ph * (1 - ph) * (1 / (n + 20::DOUBLE) + 1 / (lag(n) OVER s + 20::DOUBLE))) AS INT), 0) AS gap
  FROM sib WINDOW s AS (PARTITION BY host, parent, shape ORDER BY p, n, template)
), runs AS (SELECT *, sum(gap) OVER (PARTITION BY host, parent, shape ORDER BY p, n, template ROWS UNBOUNDED PRECEDING) AS run FROM gaps),
judged AS (
  SELECT host, template, (sum(k) OVER r + 20::DOUBLE * ph) / (sum(n) OVER r + 20::DOUBLE) AS purity FROM runs WINDOW r AS (PARTITION BY host, parent, shape, run)
)
SELECT p.page_id, host, path, {_rule_case("rule")} AS rule,
  coalesce({_rule_case("verdict")}, CASE WHEN purity >= {urls.BLOCK}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, template
FROM p JOIN shaped USING (host, path) JOIN judged USING (host, template)
"""

OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS v
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(v)) AS n, array_to_string(v[p : p + least(10, len(v)) - 1], ' ') AS win
  FROM b, unnest(range(1, len(v) - least(10, len(v)) + 2)) AS u(p) WHERE len(v) > 0
), places AS (
  SELECT rid, q, l.n, array_to_string(w[q : q + l.n - 1], ' ') AS win FROM d, (SELECT DISTINCT n FROM windows) l, unnest(range(1, len(w) - l.n + 2)) AS u(q)
), hits AS (SELECT rid, q, p.n, item_id FROM places p JOIN windows x ON p.n = x.n AND p.win = x.win),
words AS (SELECT rid, count(DISTINCT spot) AS n_hit FROM hits, unnest(range(q, q + n)) AS u(spot) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


OP11 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS dd,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS e
  FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, (a::INT) + 2 * (b::INT) + 4 * (c::INT) + 8 * (dd::INT) + 16 * (e::INT) AS mask, count(*) AS n,
    sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(name, bit)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
  JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INT AS before FROM orders, range(1, 6) AS s(step)
), cells AS (
  SELECT part, filter_order, step, n, good, toxic, mask & bit <> 0 AS fails, mask & before <> 0 AS gone, mask = bit AS alone, 120 // greatest(bit_count(mask), 1) AS share
  FROM steps, m
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN alone THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost, CAST(sum(CASE WHEN fails THEN n * share ELSE 0 END) AS BIGINT) AS shapley
FROM cells GROUP BY part, filter_order, step
"""

OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), x AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM x GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM x JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT a.lang, a.source, coalesce(t.n, 0) AS n, coalesce(v.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) a LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source) t USING (lang, source) LEFT JOIN v USING (lang)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000 * (coalesce(c.c, 0) + 1)::HUGEINT) // (g.n + g.v)::HUGEINT AS p,
    1 + (1000000000 * (k.c + 1)::HUGEINT) // (v.n + v.v)::HUGEINT AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE c > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM every
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

OP13 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT rid, doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda p: array_to_string(w[p : p + 2], ' ')))
    WHEN len(w) > 0 THEN [len(w) || ':' || array_to_string(w, ' ')] ELSE [] END AS set FROM d
), x AS (SELECT rid, len(set) AS n, unnest(set) AS shingle FROM s),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.rid <> b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT DISTINCT a AS rid, a AS other FROM links UNION SELECT r.rid, l.b FROM reach r JOIN links l ON r.other = l.a
), c AS (SELECT r.rid, min(s.doc_id) AS component_id FROM reach r JOIN s ON r.other = s.rid GROUP BY r.rid)
SELECT s.doc_id, CAST(len(set) AS BIGINT) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.rid = c.rid
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": OP1,
        "op2_url_filters": OP2,
        "op5_decontamination": OP5,
        "op11_filter_interaction": OP11,
        "op12_source_divergence": OP12,
        "op13_ngram_jaccard": OP13,
    }
