"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges`` has two columns of one orderable type. Returns (node, component) for every node with an edge to
    another one; ``component`` is the smallest node reachable.

    Null ends, loops and repeated edges are ignored; an empty table gives an empty one. Every round is grouped minima
    and equi-joins over the edges, stored afterwards; a hub is a skewed join key, which adaptive execution splits, and
    no neighbour list is ever gathered. The number of rounds grows with the logarithm of the longest path.
    """
    a, b = edges.columns
    now = scratch.store(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    seen = _state(now)
    while seen[0]:
        new = scratch.store(_small_star(_large_star(now)))
        state = _state(new)
        scratch.drop(now)
        now = new
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges: equal edges, equal state."""
    hashed = F.xxhash64("u", "v")
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(hashed.cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("v", "u")),
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them. Edges point from larger to
    smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
