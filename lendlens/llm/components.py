"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): for every id on an edge (u, v) the smallest id that it reaches.

    Only minima per id are aggregated and joined back, so a hub's neighbours
    are never gathered; each round is a written table, and a round that
    changes nothing ends the loop.
    """
    edges = written(edges.where("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long")).distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        edges = written(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == mark:
            return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        mark = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
