"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.workspace import Workspace


def connected_components(edges: DataFrame, work: Workspace, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges(a, b)``: undirected, repeated edges and loops allowed, null ends ignored; a node that has only loops doesn't
    come out. Alternates the large-star and small-star steps of Kiveris et al. (2014): each round takes aggregations by
    node with map-side combining and an equi-join, so a hub of any degree isn't gathered in one task (AQE splits the hot side), and each
    round's edges are written to the shared folder. No edge reaches the driver, only three numbers that tell whether a round changed anything.
    """
    a, b = F.col("a"), F.col("b")
    now = work.cut(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(most_rounds):
        new = work.cut(_small_star(_large_star(now)), "stars")
        work.drop(now)
        now = new
        mark = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components: no end after {most_rounds} rounds")
    # at the end every edge leads from a node to the smallest of its component
    return now.select(a.alias("node"), b.alias("component")).union(now.select(b.alias("node"), b.alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    larger = both.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
