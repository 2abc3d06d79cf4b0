"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_kept, keep


def contracted(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step on written links: edges (u, v), u > v, written, of the same
    components, and no more of them. Columns are taken by place, so the edges and further links give a next step.

    A step replaces a node's edges by edges to its smallest neighbour: grouped minima and joins, so a
    node with very many links is pre-aggregated by the minimum and its rows can be split."""
    a, b = links.columns
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .distinct())                             # one exchange for both of its uses
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(low.select("u", "m")))
    return keep(small.distinct(), "edges")


def labels(edges: DataFrame) -> DataFrame:
    """(node, root) of each upper end of ``contracted`` edges: two nodes of one root are connected; other
    nodes are their own root. Of stars, the components."""
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, or edges to larger ones only."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 AND up > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): the smallest node that each linked node reaches.

    ``links`` are read twice. Edges are written between steps, until they are stars;
    nodes without a link to another node are not in the result."""
    edges = contracted(links)
    while not _stars(edges):
        before, edges = edges, contracted(edges)
        drop_kept(before)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
