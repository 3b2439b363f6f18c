"""Connected components by alternating large-star and small-star operations on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import stored


def _least_known(pairs: DataFrame) -> DataFrame:
    """Per node ``u`` the least of itself and its neighbours ``v``; summed up before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Link each neighbour above a node to the least node of its neighbourhood."""
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    return (
        both.where("v > u").join(_least_known(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its neighbours below it to the least of them."""
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_known(down)
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) of every node that has an edge in ``edges`` (``u``, ``v``).

    The root is the least node that can be reached. Both operations keep the components; they
    alternate until neither changes the edges, which then are stars. Each round is written to the
    shared folder: a lost executor costs a part of one round. A node's neighbours are never
    gathered, only their minimum.
    """
    current = stored(small_star(edges.select("u", "v")), "stars")
    seen = _state(current)
    while seen[0]:
        current = stored(small_star(large_star(current)), "stars")
        now = _state(current)
        if now == seen:
            break
        seen = now
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
