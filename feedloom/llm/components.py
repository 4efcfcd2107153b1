"""Connected components by hooking and pointer jumping on staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (``a, b`` long).

    Returns ``node, root`` for every node that occurs in an edge.  A round
    jumps each pointer to its grandparent and hooks nodes and their parents
    onto the smallest grandparent among neighbours, so rounds grow with the
    logarithm of a component's diameter.  Every join reads two staged tables;
    a hub or a giant component is a hot key that adaptive execution splits,
    and every aggregate is a minimum with map-side combine.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b"), "both")
    tree = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n")).select("node", F.least("node", "n").alias("root")), "tree")
    total = tree.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
    while total is not None:
        up = tree.select(F.col("node").alias("_n"), F.col("root").alias("grand"))
        jumped = stage(tree.join(up, tree["root"] == up["_n"]).select("node", "root", "grand"), "jumped")
        seen = jumped.select(F.col("node").alias("_n"), F.col("grand"))
        hooks = both.join(seen, both["b"] == seen["_n"]).groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("root"))
        hooks = stage(hooks, "hooks")
        over = hooks.select(F.col("node").alias("_n"), F.col("root").alias("low"))
        parents = jumped.join(over, jumped["node"] == over["_n"]).select(F.col("root").alias("node"), F.col("low").alias("root"))
        tree = stage(
            jumped.select("node", F.col("grand").alias("root")).union(hooks.select("node", "root")).union(parents).groupBy("node").agg(F.min("root").alias("root")),
            "tree",
        )
        now = tree.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return tree
        total = now
    return tree
