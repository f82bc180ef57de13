"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.session import Scratch


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each node ``u`` with the smallest of itself and its neighbours ``v``."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_lowest(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    return (down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionAll(low.select("u", F.col("low").alias("v")))
            .where("u > v").distinct())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)`` that is not itself a root.

    ``root`` is the smallest node reachable. Only minima per node are gathered, combined in the
    map tasks, so a node with very many links is no burden; the joins are plain equi-joins which
    AQE splits. Every round is written to the shared scratch folder. Null ends are ignored, links
    of a node to itself too; without links the result is empty.
    """
    links = scratch.save(links.where("u is not null and v is not null and u <> v")
                         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .distinct(), "links")
    mark = None
    while True:
        found = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(found) == mark or found[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(found)
        links = scratch.save(_small_star(_large_star(links)), "links")
