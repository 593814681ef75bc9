"""Connected components by alternating stars; links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebook.llm.text import cut


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for all nodes of the links ``a``, ``b``.

    Each round hangs the larger neighbours of every node on the smallest one (large star), then
    the smaller ones (small star), until the links no longer change; the rounds grow with the
    logarithm of a component's width. Minima are combined before they are shuffled, and each
    round starts from a written table. Null ends and loops are no links.
    """
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                              F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = cut(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return (moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(moved.select("u", "m")).filter("u <> v").distinct())
