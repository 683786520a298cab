"""Connected components of links, by alternating star steps.

Each step hangs the neighbours of every vertex on the smallest of them: first those above it, then those below. Paths shrink
to stars in a logarithmic number of rounds. A round is written to shared storage, which cuts the lineage. Minima are
aggregated before the shuffle, and a hub's links are only ever joined with one row, so Spark can split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.sources.scratch import materialize


def _hang(links: DataFrame, upward: bool) -> DataFrame:
    """One star step over links ``(u, v)`` with ``u > v``."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if upward else links
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least, "u")
    if upward:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every end of a link: the smallest node that it reaches.

    Links of a node to itself, repeated links and links with a null end are ignored; no links give no rows.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = materialize(edges, "links")
    while True:
        done = edges.groupBy("u").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if done is None or done == 1 and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        edges = materialize(_hang(_hang(edges, True), False), "links")
    ends = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(ends)
