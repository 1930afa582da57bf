"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.operators.balance import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of the links ``a, b``: the smallest node it is connected with.

    Each round takes the smallest node around a node and then the smallest one around that, and replaces
    nodes by it in the links. Links within one node are dropped, so a star is done at once and a round
    reads only what the rounds before have left open. The smallest node of a component is never replaced.
    Minima are combined before the shuffle, so a node with very many links is no hot spot.
    """
    ends = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    open_links = written(links.where("a <> b").select(*ends).distinct(), "open-links")
    rounds = []
    while not rounds or not open_links.isEmpty():
        both = open_links.select(F.col("a").alias("node"), F.col("b").alias("to")).union(open_links.select("b", "a"))
        nearest = written(both.groupBy("node").agg(F.least("node", F.min("to")).alias("to")), "nearest")
        beyond = nearest.select(F.col("node").alias("to"), F.col("to").alias("component"))
        label = written(nearest.join(beyond, "to").select("node", "component"), "labels")
        rounds.append(label)
        for end in ("a", "b"):
            open_links = open_links.join(label.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("component", end)
        open_links = written(open_links.where("a <> b").select(*ends).distinct(), "open-links")
    found = rounds.pop()
    while rounds:
        beyond = found.select(F.col("node").alias("component"), F.col("component").alias("least"))
        found = rounds.pop().join(beyond, "component", "left").select("node", F.coalesce("least", "component").alias("component"))
    return written(found, "components-found")
