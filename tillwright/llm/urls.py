r"""URL filters: host rules, and a path-template tree judged by labelled purity.

1. *Templates.* A path is cut at ``/`` into segments. A segment that looks
   like an identifier (digits, hex, long mixed strings) becomes ``*``, its
   file extension kept. A segment that few rows of its host have at its depth
   (labels and distinct paths together below ``MIN_SUPPORT``) becomes ``*``
   too, if it has siblings as rare; one with more rows stays a node of the
   host's tree, however many siblings it has.
2. *Branches.* Sibling branches (below one node of a host's tree, of equal
   depth and equal last segment's shape) are ordered by their smoothed share of bad labels; neighbours closer than
   ``Z`` standard errors are merged into one branch, so rare templates borrow
   the labels of those that behave like them.
3. *Verdict.* A branch is blocked when the smoothed purity of its bad labels
   ``(bad + PRIOR * host share) / (labelled + PRIOR)`` reaches ``BLOCK``; the
   host's share is smoothed towards the corpus in the same way. Explicit
   rules decide before templates; the longest fitting rule wins.

Only DataFrame functions run here. Segments are counted by partial aggregation
before any shuffle, in time linear in a path's length; the per-template tables are joined back on (host,
template), small rows only, where a hot host is spread over its templates. Siblings
are ordered by their distinct pairs of counts, not one by one.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and forms the template of the empty path of the empty host; an
empty path fits no rule (each rule's path starts with ``/``); rows repeating
a ``page_id`` are judged each by its own url; without labels every template
is allowed. Only page_id and url are read (of labels url and bad); other
columns may have any name and are not returned; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: (verdict, host, path prefix); a rule holds for the host and its subdomains.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labels and distinct paths from which a segment is a section of its own.
MIN_SUPPORT = 8
Z = 1.0
PRIOR = 20.0
BLOCK = 0.6
#: A segment that identifies a thing rather than a section, less its extension.
VARIABLE = r"\A(?:[0-9]+|[0-9a-fA-F-]{8,}|(?=[^/]*[0-9])[A-Za-z0-9_-]{12,})(\.[A-Za-z]{1,5})?\z"


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), CAPITALS, SMALL)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": host, "path": path})


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, of, prefix in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == of) | F.endswith(host, F.lit(f".{of}"))) & F.startswith(path, F.lit(prefix))
        rule = F.when(fits, F.lit(of + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _general(segments: Column) -> Column:
    """Segments with identifiers as wildcards."""
    return F.transform(segments, lambda s: F.when(s.rlike(VARIABLE), F.concat(F.lit("*"), F.regexp_extract(s, VARIABLE, 1))).otherwise(s))


def templates(paths: DataFrame) -> DataFrame:
    """Distinct (host, path, n, ...) rows with ``template``; n is the path's number of labels."""
    df = paths.withColumn("_segments", _general(F.split(F.col("path"), "/")))
    df = df.withColumn("_key", F.sha2(F.concat_ws("/", "host", F.array_join("_segments", "/")), 256))
    # Many paths are one after generalising: take each once before it is cut up.
    general = df.groupBy("host", "_key").agg(F.first("_segments").alias("_segments"), F.sum(F.col("n") + 1).alias("support"))
    places = general.select("host", "_key", "support", F.posexplode("_segments").alias("depth", "segment"))
    support = places.filter(~F.startswith("segment", F.lit("*"))).groupBy("host", "depth", "segment").agg(F.sum("support").alias("support"))
    rare = support.filter(F.col("support") < MIN_SUPPORT).drop("support")
    several = rare.groupBy("host", "depth").agg(F.count("*").alias("members")).filter("members > 1").drop("members")
    rare = rare.join(several, ["host", "depth"]).withColumn("_rare", F.lit(True))
    marked = places.drop("support").join(rare, ["host", "depth", "segment"], "left")
    named = F.struct("depth", F.when(F.col("_rare"), F.lit("*")).otherwise(F.col("segment")).alias("segment"))
    made = marked.groupBy("_key").agg(F.sort_array(F.collect_list(named)).alias("all"))  # the segments of one path
    made = made.select("_key", F.array_join("all.segment", "/").alias("template"))
    return df.join(made, "_key").drop("_segments", "_key")


def branches(paths: DataFrame) -> DataFrame:
    """(host, template, branch, purity) of (host, template, n, k): labelled and bad labels of each path."""
    nodes = paths.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    hosts = nodes.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk"))
    whole = hosts.agg((F.sum("hk") / F.greatest(F.sum("hn"), F.lit(1))).alias("p0"))
    hosts = hosts.withColumn("p0", whole.scalar())
    hosts = hosts.select("host", ((F.col("hk") + PRIOR * F.coalesce("p0", F.lit(0.0))) / (F.col("hn") + PRIOR)).alias("ph"))
    nodes = nodes.join(hosts, "host").withColumns(
        {
            "parent": F.regexp_extract("template", r"\A((?s:.*))/[^/]*/[^/]*\z", 1),
            "shape": F.concat(F.size(F.split("template", "/")).cast("string"), F.regexp_extract("template", r"(\*?(?:\.[A-Za-z]{1,5})?)\z", 1)),
            "p": (F.col("k") + PRIOR * F.col("ph")) / (F.col("n") + PRIOR),
        }
    )
    # Siblings of equal counts have equal shares and end up in one branch, so the
    # order is over distinct counts: few rows, however many siblings a node has.
    alike = ["host", "parent", "shape", "n", "k"]
    counts = nodes.groupBy(*alike).agg(F.first("p").alias("p"), F.first("ph").alias("ph"), F.count("*").alias("m"), F.min("template").alias("least"))
    siblings = "PARTITION BY host, parent, shape ORDER BY p, n"
    spread = F.sqrt(F.col("ph") * (1 - F.col("ph")) * (1 / (F.col("n") + PRIOR) + 1 / (F.expr(f"lag(n) OVER ({siblings})") + PRIOR)))
    counts = counts.withColumn("_gap", F.coalesce((F.col("p") - F.expr(f"lag(p) OVER ({siblings})") > Z * spread).cast("int"), F.lit(0)))
    counts = counts.withColumn("_run", F.expr(f"sum(_gap) OVER ({siblings} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    run = "PARTITION BY host, parent, shape, _run"
    purity = F.expr(f"(sum(k * m) OVER ({run}) + {PRIOR} * ph) / (sum(n * m) OVER ({run}) + {PRIOR})")
    counts = counts.select(*alike, F.expr(f"min(least) OVER ({run})").alias("branch"), purity.alias("purity"))
    return nodes.select("template", *alike).join(counts, alike).select("host", "template", "branch", "purity")


def judged(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, branch, purity) of every
    row of ``pages`` (page_id, url). ``labels``: rows (url, bad) with bad 0, 1
    or null; their urls need not be among the pages."""
    parts = with_parts(pages.select("page_id", "url")).drop("url")
    known = with_parts(labels.select("url", F.col("bad").cast("bigint").alias("bad"))).groupBy("host", "path")
    known = known.agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    unseen = parts.select("host", "path").distinct().withColumns({"n": F.lit(0).cast("bigint"), "k": F.lit(0).cast("bigint")})
    paths = known.unionByName(unseen).groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    paths = staged(templates(paths), "url-templates")
    found = paths.join(branches(paths), ["host", "template"]).select("host", "path", "template", "branch", "purity")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = parts.join(found, ["host", "path"], "left").withColumns({"rule": rule, "_by_rule": verdict})
    by_branch = F.when(F.col("purity") >= BLOCK, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("_by_rule", by_branch).alias("verdict"), "template", "branch", "purity"
    )


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of pages whose url ends in the number of a labelled document."""
    number = F.regexp_extract(F.coalesce("url", F.lit("")), r"/([0-9]{1,18})(?:\.html|/)?(?:[?#]|\z)", 1)
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    return pages.select("url", F.when(number != "", number.cast("bigint")).alias("doc_id")).join(known, "doc_id").select("url", "bad")
