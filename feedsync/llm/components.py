"""Connected components of a table of links, on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(low, "u")
    return (
        tied.filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(low.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node of each linked node's component.

    Large-star and small-star steps alternate until the links are stars.  Each step
    is a pre-aggregated minimum and a join, so a node with very many links is
    shared out; every round is written to the shared folder, which cuts the lineage."""
    edges = staged(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "components",
    )
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = now
        edges = staged(_small_star(_large_star(edges)), "components")
