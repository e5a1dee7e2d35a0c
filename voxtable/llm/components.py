"""Connected components of a graph too large for one task, by alternating star operations.

Each round is two stars (Kiveris et al., "Connected Components in MapReduce and Beyond"): a large
star links the larger neighbours of a node to its smallest neighbour, a small star links the
smaller ones and the node itself to it. Every round is stored, and hubs are joined by broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import join_counted
from voxtable.sources.tables import materialize


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)`` that is not itself the smallest it
    reaches, where ``root`` is that smallest node. Links have no direction; repeats do no harm."""
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stars = materialize(links.where("a <> b").select(larger, smaller).distinct())
    before = None
    while before != (state := _state(stars)):
        before = state
        stars = materialize(_small_star(materialize(_large_star(stars))))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(stars: DataFrame) -> tuple:
    """Number and checksum of the links: the same twice means that a round changed nothing."""
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(stars: DataFrame) -> DataFrame:
    both = materialize(stars.union(stars.select("v", "u").toDF("u", "v")))
    smallest = both.groupBy("u").agg(
        F.least("u", F.min("v")).alias("smallest"), F.count("*").alias("n")
    )
    joined = join_counted(both, materialize(smallest), "u", "n", both.count())
    larger = joined.where("v > u").select(F.col("v").alias("u"), F.col("smallest").alias("v"))
    return larger.where("u <> v").distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    smallest = materialize(
        stars.groupBy("u").agg(F.min("v").alias("smallest"), F.count("*").alias("n"))
    )
    joined = join_counted(stars, smallest, "u", "n", stars.count())
    below = joined.select(F.col("v").alias("u"), F.col("smallest").alias("v"))
    return below.union(smallest.select("u", F.col("smallest").alias("v"))).where("u <> v").distinct()
