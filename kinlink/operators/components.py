"""Connected components of an undirected graph given as an edge table, by alternating star contraction.

Each round rewrites the edges with joins and map-side combined minima only. A hub that touches a third of all rows is one key
of an aggregation (combined before the shuffle) and the single-row side of a join whose other side AQE may split.
The lineage is cut with checkpoint() after each round. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    kept = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return kept.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of edges(a, b); component is the least node of its component.

    Edges with a null end are left out; a self-loop makes its node a component of its own unless other edges say
    otherwise; repeated edges change nothing; no edges give no rows.
    """
    clean = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = clean.select(F.col("a").alias("node")).unionByName(clean.select(F.col("b").alias("node"))).distinct()
    stars = cut(clean.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        stars = cut(_small_star(_large_star(stars)).distinct())
        # converged when no edge changed: count and an order-free checksum of the edges, two numbers
        now = tuple(stars.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no convergence in {max_rounds} rounds")
    return nodes.join(stars.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
