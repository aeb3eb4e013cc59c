"""Connected components by alternating large and small stars, with tables between the rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.plans.lineage import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node that it reaches.

    Only edges move, never a whole component. Each round writes its edges to the shared folder, so a
    lost executor repeats one round at most. Ends when a round changes nothing, after about log(n) rounds.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut_lineage(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        edges = cut_lineage(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
