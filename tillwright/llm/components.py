"""Connected components by contraction.

Each round hooks every node to its smallest neighbour, shortens the hooks to
their roots by pointer jumping, and rewrites the edges to roots, without loops
and doubles. So edges that have done their work are not joined again, and the
rows of a round are those that still connect different roots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, staged_at


def _roots(parents: DataFrame) -> tuple[DataFrame, str]:
    """(node, root) of ``parents`` (node, root): each node looks up the root of its root until none has one."""
    spark = parents.sparkSession
    now, at = staged_at(parents, "hooks")
    while True:
        up = now.select(F.col("node").alias("_up"), F.col("root").alias("_root"))
        jumped = now.join(up, F.col("root") == F.col("_up"), "left")
        new, new_at = staged_at(jumped.select("node", F.coalesce("_root", "root").alias("root"), (F.col("_root") != F.col("root")).alias("moved")), "hooks")
        dropped(spark, at)
        now, at = new.select("node", "root"), new_at
        if not new.filter("moved").limit(1).count():
            return now, at


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (x, y): the smallest node it is connected with."""
    spark = edges.sparkSession
    now, at = staged_at(edges.filter("x != y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "edges")
    labels = label_at = None
    while True:
        both = now.select("x", "y").union(now.select("y", "x"))
        hooks = both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("root"))
        roots, roots_at = _roots(hooks)
        if labels is None:
            labels, label_at = roots, roots_at
        else:
            new = labels.join(roots.select(F.col("node").alias("_node"), F.col("root").alias("_root")), F.col("root") == F.col("_node"), "left")
            new, new_at = staged_at(new.select("node", F.coalesce("_root", "root").alias("root")), "labels")
            dropped(spark, label_at)
            labels, label_at = new, new_at
        one = now.join(roots.select(F.col("node").alias("x"), F.col("root").alias("a")), "x").join(roots.select(F.col("node").alias("y"), F.col("root").alias("b")), "y")
        rest, rest_at = staged_at(one.filter("a != b").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct(), "edges")
        dropped(spark, at)
        if roots_at != label_at:
            dropped(spark, roots_at)
        now, at = rest, rest_at
        if not now.limit(1).count():
            dropped(spark, at)
            return labels.select("node", F.col("root").alias("label"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(cid, label) after ``links`` (labels x, y) made the components of ``labels`` (cid, label) that they connect one each."""
    new = components(links).select(F.col("node").alias("label"), F.col("label").alias("_new"))
    return labels.join(new, "label", "left").select("cid", F.coalesce("_new", "label").alias("label"))
