"""Connected components of a graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.session import cut_lineage


def _marks(edges: DataFrame) -> tuple:
    """Changes whenever the set of edges does."""
    hashed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest one around it."""
    both = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    linked = both.where("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Needs u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where("v > m")
    return (
        linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(pairs: DataFrame) -> DataFrame:
    """Columns ``node``, ``component`` for every id in the two columns of ``pairs``.

    The component is the smallest id that can be reached. Large-star and small-star steps
    take turns until every node hangs on its smallest one, a number of rounds that grows
    with the logarithm of the longest path. Each round is cut off in the shared folder.
    Pairs with a NULL or two equal ids are no links.
    """
    left, right = pairs.columns
    edges = pairs.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    )
    edges = cut_lineage(edges.distinct())
    before = _marks(edges)
    while before[0]:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _marks(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots
    )
