"""Connected components of a large graph, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.tables import settled


def _nearest(edges: DataFrame) -> DataFrame:
    """Each u with the smallest of itself and its neighbours, beside every v it is linked with."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) for every id that has an edge.

    `edges` has two integer columns u and v. Every round points a node's larger neighbours, then
    the node and its smaller ones, to the smallest; ends when a round changes nothing, after
    about as many rounds as the logarithm of the longest path. A node's links are never gathered.
    """
    edges = settled(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_nearest(both).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        near = _nearest(large)
        edges = settled(
            near.select("u", F.col("m").alias("v"))
            .unionByName(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(), "edges")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"),
                        F.sum(F.crc32(F.concat_ws(",", "u", "v").cast("binary")))).first()
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
        before = now
