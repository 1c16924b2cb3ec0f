"""Connected components by alternating stars.

Each round re-hangs the neighbours of a node under the smallest of them: the larger ones in
the first half, the smaller ones in the second. All of it is minima by key and equi-joins, so
a hub costs rows in a join that can be split, never a list in one task. Each round's edges
are written to the shared folder, which ends the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.llm.common import stored


def _stars(pairs: DataFrame) -> DataFrame:
    """(u, v) with the smallest of u's neighbours and u itself: (u, v, m)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """`links` (a, b) of a sortable type: (node, root) for every node with a link, where root is
    the smallest node of its component. Links of a node to itself are ignored; the order of ends
    and repeated links do not matter. No links give no rows."""
    edges = (
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    edges = stored(edges, "links")
    seen = _mark(edges)
    if not seen[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        star = _stars(large)
        small = star.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(star.select("u", F.col("m").alias("v"))).distinct(), "stars")
        mark = _mark(edges)
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
