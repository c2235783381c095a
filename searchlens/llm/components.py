"""Connected components of a table of links, by alternating large-star and small-star rounds.

Every round ties each node to the smallest neighbour it knows, so paths of any length shrink to stars in about
log(length) rounds. A round is two joins against one row per node, which also has the number of the node's links: the
few nodes with many of them, such as the centre of a star of a third of all nodes, are joined by broadcast. Each round
is written to the shared folder, so a lost executor costs one round at most, and links never leave the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, saved


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame, total: int, name: str) -> DataFrame:
    """Every neighbour larger than a node is tied to the smallest of the node and its neighbours."""
    near = _both_ways(links)
    larger = near.where("v > u")
    least = saved(near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n")),
                  f"{name}-least")
    return lookup(larger, least, "u", "n", total).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame, total: int, name: str) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. ``links`` is a written table."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = saved(down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), f"{name}-least")
    moved = lookup(down, least, "u", "n", total).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node of ``links`` (u, v): the label is the smallest node it can reach.

    Links may repeat and may run either way; a node linked to itself alone is not listed.
    """
    now = saved(links.where("u != v").select("u", "v").distinct(), f"{name}-0")
    before, k = None, 0
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before, k = state, k + 1
        large = saved(_large_star(now, state[0], f"{name}-{k}-large").distinct(), f"{name}-{k}-large")
        now = saved(_small_star(large, large.count(), f"{name}-{k}-small").distinct(), f"{name}-{k}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
