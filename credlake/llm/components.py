"""Connected components of a graph given as edges, by alternating star contraction.

Large-star links every larger neighbour of a node to the smallest node that
the node sees; small-star does the same with the smaller neighbours.  Both
are a minimum per node (combined before the shuffle) joined back to the
edges, so a node with a third of all edges is split like any skewed join and
no neighbour list is ever gathered.  When nothing changes, every node points
at the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credlake.llm.common import stored


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point down (u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionAll(least.select("u", F.col("least").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v), both long; root is the smallest node reachable.

    Loops and rows with a null end are ignored; without edges the result is
    empty.  Each round is written to the shared folder.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _summary(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        last, seen = seen, _summary(now)
        if last == seen:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
