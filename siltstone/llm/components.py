"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component) for every id that a link touches; the component is its smallest id.

    Each round sends every neighbour to the smallest one it knows; all work is aggregates and equi
    joins on the id, so that a hot id is combined before the shuffle or split by the skew join. A
    round is written to the shared folder, which cuts the lineage. Links from an id to itself or with
    a null end are left out.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    edges = links.sparkSession.createDataFrame([], edges.schema) if edges.isEmpty() else edges
    edges = stored(edges.where("u > v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == before or not state["n"]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct().toDF("id", "component")
            )
        before = state
        edges = stored(_small_star(_large_star(edges)), "links")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    sent = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return sent.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    sent = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return sent.union(least).distinct()
