"""Connected components of a link table, by alternating large and small stars.

Each turn points every node at smaller nodes among its neighbours; the table of links shrinks to a star
per component. Every turn is a grouped minimum and a join on the node, cut by a checkpoint in the cluster's
shared folder, so nothing is gathered and a lost executor costs one turn at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import shared_folder


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Joins what is larger than a node to the least around that node."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Joins a node and what is smaller around it to the least of these."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = _least(down)
    across = down.join(least, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return across.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """(u, v), v the least node of u's component, for each linked node but that one; links: (u, v), longs."""
    context = links.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(links.sparkSession))
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    state = _state(links)
    while True:
        links = _small_star(_large_star(links)).checkpoint()
        before, state = state, _state(links)
        if state == before:
            return links
