"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(id, root) for every id in ``links(a, b)``; root is the smallest id reachable.

    Alternating large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond", 2014). Every step is joins and
    aggregates with map-side combine: a vertex with a third of all links is
    one partial minimum a task, and its join partition can be split. Each
    round is written to the shared folder; links never reach the driver.
    """
    edges = (links.where("a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges = scratch.keep(edges, f"{name}0")
    seen, i = None, 0
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"),
                          F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == seen or state["n"] == 0:
            break
        seen, i = (state["n"], state["h"]), i + 1
        # Large star: every larger neighbour of u points to u's smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # Small star: u and its smaller neighbours point to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.union(low.select("u", F.col("m").alias("v"))).distinct()
        edges = scratch.keep(small, f"{name}{i}")
        scratch.drop(f"{name}{i - 1}")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
