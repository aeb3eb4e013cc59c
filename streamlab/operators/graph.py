"""Weighted PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.plans.hotkeys import PART_ROWS, hot_keys, hot_keys_of, salted_join
from streamlab.plans.lineage import cut_lineage


def out_weights(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.sum("weight").alias("outWeight"))


def transition_weights(edges: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Edges with ``weight`` divided by the total weight that leaves their source."""
    totals = edges.groupBy("src").agg(
        F.sum("weight").alias("outWeight"), F.count(F.lit(1)).alias("_edges")
    )
    hot = hot_keys_of(totals, ["src"], "_edges", part_rows)
    joined = salted_join(edges, totals, ["src"], ["dst"], part_rows=part_rows, hot=hot)
    return joined.select("src", "dst", (F.col("weight") / F.col("outWeight")).alias("weight"))


def pagerank(
    edges: DataFrame,
    damping: float = 0.85,
    iterations: int = 10,
    init: float = 1.0,
    checkpoint_every: int = 5,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``(id, rank)`` after a fixed number of rounds of ``(1-d)/N + d * sum(rank * weight)``.

    The transition table, the ranks of every few rounds and the result are written to the shared folder. Vertices
    are numbered, and the edges dealt by their source and sorted once and kept so while the rounds last: a round
    shuffles contributions, summed per task, and a vertex without incoming edges takes part with a zero
    contribution instead of a join. With a hot source the edges are dealt anew in each round, with a salt.
    """
    transitions = cut_lineage(transition_weights(edges, part_rows), "transitions")
    ends = transitions.select(F.explode(F.array("src", "dst")).alias("id"))
    # Numbers are read back from the table, so they stay.
    vertices = cut_lineage(ends.distinct().withColumn("_n", F.monotonically_increasing_id()), "vertices")
    hot = hot_keys(transitions, ["src"], part_rows)
    # Known before the rounds, so that no round counts again; mostly there is none.
    hot = None if hot.isEmpty() else cut_lineage(hot, "hot-sources")
    base = (1.0 - damping) / max(vertices.count(), 1)
    sources = vertices.withColumnsRenamed({"id": "src", "_n": "_src"})
    targets = vertices.select(F.col("id").alias("_id"), F.col("_n").alias("_dst"))
    if hot is None:
        carried = transitions.join(sources, "src")
    else:
        carried = salted_join(transitions, sources, ["src"], ["dst"], part_rows=part_rows, hot=hot)
        hot = cut_lineage(hot.join(sources, "src").select("_src", "_parts"), "hot-numbers")
    # A null source passes nothing on, a null target gets its share.
    numbered = carried.join(targets, F.col("dst").eqNullSafe(F.col("_id"))).select("_src", "_dst", "weight")
    if hot is None:
        # As many partitions as the sums of a round have, so that ranks meet the edges where they are.
        width = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        numbered = numbered.repartition(width, "_src").sortWithinPartitions("_src").persist()
    else:
        numbered = cut_lineage(numbered, "numbered")
    none = vertices.select("_n", F.lit(0.0).alias("_in"))
    ranks = vertices.select("_n", F.lit(float(init)).alias("rank"))
    try:
        for step in range(1, iterations + 1):
            given = ranks.withColumnRenamed("_n", "_src")
            if hot is None:
                carried = numbered.join(given, "_src")
            else:
                carried = salted_join(numbered, given, ["_src"], ["_dst"], part_rows=part_rows, hot=hot)
            sent = carried.select(F.col("_dst").alias("_n"), (F.col("rank") * F.col("weight")).alias("_in"))
            ranks = (
                sent.unionByName(none)
                .groupBy("_n")
                .agg((F.lit(base) + F.lit(damping) * F.sum("_in")).alias("rank"))
            )
            if step % checkpoint_every == 0 or step == iterations:
                ranks = cut_lineage(ranks, "ranks")
    finally:
        if hot is None:
            numbered.unpersist()
    return vertices.join(ranks, "_n").select("id", "rank")
