"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import looked_up, stored


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to (node, component): the smallest node that each node can reach.

    Each round links neighbours to the smallest of them. A node's neighbours meet only in a minimum (pre-aggregated); the
    minimum of a node of very many goes to where they are (``looked_up``), so such a node is no bottleneck. Rounds grow
    with the logarithm of the size. Each round's edges are a table in the shared folder.
    """
    nodes = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    links, mark = stored(nodes, "links"), None
    while True:
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or (now["n"], now["h"]) == mark:
            break
        mark = (now["n"], now["h"])
        links = stored(_small_star(stored(_large_star(links), "links")), "links")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
    more = looked_up(both.where("v > u"), stored(least, "least"), "u", "n")
    return more.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = stored(links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
    other = looked_up(links, least, "u", "n").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return own.unionByName(other).where("u <> v").distinct()
