"""Classes of records from sure and unsure links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.components import connected_components
from kinlink.session import cut


def link_classes(nodes: DataFrame, links: DataFrame, sure: int = 2) -> DataFrame:
    """(node, cls) for each row of nodes(node). Links(a, b, score) of at least `sure` join; the class a node then has is joined to
    another one over weaker links only if each of the two has no weaker link to a third class. Nodes without links are classes of their own."""
    strong = connected_components(links.where(F.col("score") >= sure).select("a", "b"))
    of = cut(nodes.select("node").join(strong, "node", "left").select("node", F.coalesce("component", "node").alias("c")))
    weak = links.where(F.col("score") < sure).select("a", "b")
    weak = weak.join(of.select(F.col("node").alias("a"), F.col("c").alias("ca")), "a").join(of.select(F.col("node").alias("b"), F.col("c").alias("cb")), "b")
    weak = weak.where("ca <> cb").select("ca", "cb").distinct()
    both = cut(weak.unionByName(weak.select(F.col("cb").alias("ca"), F.col("ca").alias("cb"))).distinct())
    lone = both.groupBy("ca").agg(F.count("*").alias("n")).where("n = 1").select("ca")
    fit = both.join(lone, "ca", "left_semi").join(lone.select(F.col("ca").alias("cb")), "cb", "left_semi")
    joined = fit.select("ca", F.least("ca", "cb").alias("c2")).distinct()  # each of the two has the other as its only one
    return of.join(joined, of["c"] == joined["ca"], "left").select("node", F.coalesce("c2", "c").alias("cls"))
