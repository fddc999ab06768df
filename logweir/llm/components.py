"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import stored


def _smallest_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low"))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.*")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or the node)."""
    around = _both_ways(links)
    low = _smallest_neighbour(around).select("u", F.least("u", "low").alias("low"))
    return (around.filter("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Links have u > v."""
    moved = links.join(_smallest_neighbour(links), "u")
    return (moved.select(F.explode(F.array(
        F.struct("u", F.col("low").alias("v")),
        F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("x"))
        .select("x.*").filter("u > v").distinct())


def connected_components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that is reachable, for nodes other than that smallest one.

    ``links`` has two comparable columns, in either direction; rows with a null or with both ends
    alike are no links. Rounds go on until nothing changes; their number grows with the logarithm
    of the longest chain. Each is written to the checkpoint folder, so a lost executor costs one
    round at most. A hub is met by a map-side minimum and by a join whose large side can be split.
    """
    a, b = links.columns
    state = stored(links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            return state.select(F.col("u").alias("node"), F.col("v").alias("label"))
        mark, state = now, stored(_small_star(_large_star(state)))
