"""Connected components of a distributed edge list (alternating star contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import staged


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def _star(edges: DataFrame, name: str) -> DataFrame:
    """(u, v) joined to m, the least v of u.  The minima are stored first: the
    join then has two plain shuffles, so that a hub's edges are split over
    tasks by the adaptive skew join."""
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), name)
    return edges.join(least, "u")


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``edges`` (u, v), any order and repeats -> (node, root), root the least node reachable.

    Each round hangs the larger neighbours of a node on its least neighbour
    (large star), then each node's smaller neighbours likewise (small star);
    the number of rounds grows with the logarithm of the graph.  Every step is
    a partial aggregate and a join; each round's edges are stored in the
    shared folder.  Nodes without an edge are not returned.
    """
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    mark = _print(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = now.union(now.select("v", "u")).toDF("u", "v")
        large = (_star(both.union(both.select("u", "u")), "cc-least").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = staged(large, "cc-large")
        hung = _star(large, "cc-least")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", "m")).where("u <> v").distinct()
        now = staged(small, "cc-edges")
        before, mark = mark, _print(now)
        if before == mark:
            break
    else:
        raise RuntimeError("components did not converge")
    star = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.union(now.select("v", "v")).distinct()
