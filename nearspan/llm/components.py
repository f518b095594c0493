"""Connected components of a graph given as rows of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b``: the root is the smallest node of its component.

    Each round hooks every node to its smallest neighbour, follows the hook once more and contracts
    the edges, which shrinks chains by a factor; a star of any size takes one round.  Only sums per
    node cross the shuffles, and every round is written, so a lost executor costs one round.
    """
    live = settle(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    roots = None
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hooks = settle(hooks.select("node", F.least("node", "low").alias("up")), "hooks")
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("next"))
        jumped = settle(hooks.join(above, "up").select("node", F.col("next").alias("up")), "jumped")
        if roots is None:
            roots = jumped.select("node", F.col("up").alias("root"))
        else:
            known = jumped.select(F.col("node").alias("root"), "up")
            moved = F.coalesce("up", "root").alias("root")
            roots = settle(roots.join(known, "root", "left").select("node", moved), "roots")
        start = jumped.select(F.col("node").alias("a"), F.col("up").alias("x"))
        end = jumped.select(F.col("node").alias("b"), F.col("up").alias("y"))
        live = live.join(start, "a").join(end, "b").filter("x <> y")
        live = settle(live.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    return roots
