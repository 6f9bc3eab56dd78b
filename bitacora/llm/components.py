"""Connected components of a growing set of links between integers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitacora.storage import Workspace


def components(links: DataFrame, ws: Workspace) -> DataFrame:
    """Each end of a link with the smallest integer it is connected to: id, component.

    Every round links each node to the smallest of its neighbourhood, once for its
    larger and once for its smaller neighbours, until stars are left: the number of
    rounds grows with the logarithm of the longest path.  Smallest neighbours are
    partial minima before anything is moved.  They are written before they are joined:
    in a join of plain tables Spark can split the rows of a hub.
    """
    edges, seen = ws.stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u > v")
        .distinct(),
        n=F.count(F.lit(1)),
    )
    while seen["n"]:
        # Larger neighbours of u, and u itself, to the smallest neighbour of u.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, _ = ws.stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, _ = ws.stage(large.distinct())
        # Smaller neighbours of u, and u itself, to the smallest of them.  A pair that
        # is new, or whose smaller end has a smaller neighbour itself, needs a round more.
        least, _ = ws.stage(large.groupBy("u").agg(F.min("v").alias("m")))
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.select("u", "v", F.lit(1).alias("new")).union(
            least.select("u", F.col("m").alias("v"), F.lit(0).alias("new"))
        )
        inner = least.select(F.col("u").alias("v"), F.lit(1).alias("inner"))
        edges, seen = ws.stage(
            small.groupBy("u", "v").agg(F.min("new").alias("new"))
            .join(inner, "v", "left")
            .select("u", "v", F.greatest("new", F.coalesce("inner", F.lit(0))).alias("open")),
            n=F.sum("open"),
        )
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    heads = members.select(F.col("component").alias("id")).distinct()
    return members.union(heads.select("id", F.col("id").alias("component")))
