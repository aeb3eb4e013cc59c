"""Nearest neighbours by largest inner product, with an inverted multi-index.

Both halves of the vectors have a codebook of their own, so a vector lies in one of K * K cells. A query
walks through pairs of centroids in the order of their summed inner products, from a heap, until the
cells hold a share of all vectors; the vectors in these cells are ranked by their exact inner product.
The share is found on the training sample: the smallest that reaches the wanted recall there.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from streamlab.plans.lineage import cut_lineage

#: Vectors that codebooks and share are fitted on: a bound for the driver. Every vector is indexed.
SAMPLE, SAMPLE_QUERIES, ROUNDS = 20_000, 200, 8
#: Centroids of a half, at most; so there are at most 4,096 cells.
CENTROIDS = 64
WANTED_RECALL, SHARES = 0.96, tuple(k / 20 for k in range(1, 21))
#: Cells are dealt in blocks; a block with more vectors than this is dealt in parts.
BLOCKS, PART = 16, 20_000
#: Queries that meet a part at a time; with more queries, each part is dealt once for every so many.
SLICE = 20_000


class MultiIndex(NamedTuple):
    left: np.ndarray
    right: np.ndarray
    share: float

    def cells(self, x: np.ndarray) -> np.ndarray:
        half = self.left.shape[1]
        return nearest(x[:, :half], self.left) * len(self.right) + nearest(x[:, half:], self.right)

    def probe(self, query: np.ndarray, counts: np.ndarray) -> list[int]:
        """Cells in order of summed inner products, until they hold the share of all vectors."""
        half = self.left.shape[1]
        one, two = self.left @ query[:half], self.right @ query[half:]
        rows, columns = np.argsort(-one, kind="stable").tolist(), np.argsort(-two, kind="stable").tolist()
        one, two, width = one.tolist(), two.tolist(), len(self.right)
        wanted, found, size = self.share * counts.sum(), [], counts.tolist()
        heap, seen = [(-one[rows[0]] - two[columns[0]], 0, 0)], 0
        while heap and (seen < wanted or not seen):
            _, i, j = heappop(heap)
            cell = rows[i] * width + columns[j]
            if size[cell]:
                found.append(cell)
                seen += size[cell]
            if j + 1 < width:
                heappush(heap, (-one[rows[i]] - two[columns[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(rows):
                heappush(heap, (-one[rows[i + 1]] - two[columns[0]], i + 1, 0))
        return found


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (2 * x @ centroids.T - (centroids**2).sum(axis=1)).argmax(axis=1)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds from random vectors; a centroid without vectors stays where it is."""
    centroids = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centroids)
        count = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        centroids[count > 0] = sums[count > 0] / count[count > 0, None]
    return centroids


def fit_index(sample: np.ndarray, neighbours: int, seed: int = 3) -> MultiIndex:
    """Codebooks, and the smallest share of vectors whose cells hold the wanted share of true neighbours."""
    rng = np.random.default_rng(seed)
    half, k = (sample.shape[1] + 1) // 2, int(np.clip(np.sqrt(len(sample)) / 2, 1, CENTROIDS))
    index = MultiIndex(_codebook(sample[:, :half], k, rng), _codebook(sample[:, half:], k, rng), 1.0)
    cells = index.cells(sample)
    counts = np.bincount(cells, minlength=len(index.left) * len(index.right))
    needed = []
    for i in rng.permutation(len(sample))[:SAMPLE_QUERIES]:
        exact = sample @ sample[i]
        exact[i] = -np.inf
        best = np.argsort(-exact, kind="stable")[: min(neighbours, len(sample) - 1)]
        order = index.probe(sample[i], counts)
        seen = np.cumsum(counts[order]) - counts[order]
        before = np.full(len(counts), len(sample))
        before[order] = seen
        needed.append(before[cells[best]] / len(sample))
    needed = np.concatenate(needed) if needed else np.zeros(0)
    share = next((s for s in SHARES if not len(needed) or (needed < s).mean() >= WANTED_RECALL), 1.0)
    return index._replace(share=share)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of rows whose vector can be compared: no null, no NaN or infinity, not zero."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.where(F.col(id_col).isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), v.cast(vector_type(df, vector_col)).alias("vector")
    )


def vector_type(df: DataFrame, vector_col: str) -> str:
    """Single floats stay as they are; other numbers are compared in double precision."""
    return "array<float>" if isinstance(df.schema[vector_col].dataType.elementType, FloatType) else "array<double>"


def neighbours(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose id is divisible by ``every``, the ``k`` nearest found.

    Vectors that are null, zero, or hold a null or a number that is not finite take no part, nor do
    vectors of another length than the one with the smallest id. Equal vectors are searched once: of
    each, the ``k`` + 1 smallest ids stand for all, which is all that any query can want. A repeated id
    with one vector counts once. An empty table has no rows. Other columns are left out.
    """
    rows, kind = usable(df, id_col, vector_col), vector_type(df, vector_col)
    first = rows.agg(F.min_by(F.size("vector"), "id")).first()[0]
    if first is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    rows = rows.where(F.size("vector") == first)
    by_vector = Window.partitionBy("vector").orderBy("id")
    few = rows.dropDuplicates(["id", "vector"]).withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
    distinct = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    sample = distinct.select("vector", F.col("ids")[0].alias("id")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    index = fit_index(np.array([r["vector"] for r in sample], np.float64), k)
    shared = df.sparkSession.sparkContext.broadcast(tuple(index))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = MultiIndex(*shared.value)
        for batch in batches:
            if batch.num_rows:
                cells = own.cells(_matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))], ["vector", "ids", "cell"])

    entries = cut_lineage(distinct.mapInArrow(place, f"vector {kind}, ids array<long>, cell int"), "entries")
    counts = np.zeros(len(index.left) * len(index.right), np.int64)
    for r in entries.groupBy("cell").count().collect():  # one row per cell
        counts[r["cell"]] = r["count"]
    of_block = np.bincount(np.arange(len(counts)) % BLOCKS, weights=counts, minlength=BLOCKS)
    parts = np.maximum(np.ceil(of_block / PART), 1).astype(np.int64).tolist()
    probed = df.sparkSession.sparkContext.broadcast((counts, parts))
    asked = rows.where(F.col("id") % every == 0).distinct()
    queries = asked.groupBy("vector").agg(F.min("id").alias("query"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once per block and part that holds some of its cells, with a bit per cell."""
        own, (counts, parts) = MultiIndex(*shared.value), probed.value
        for batch in batches:
            for i, query in enumerate(_matrix(batch.column("vector")) if batch.num_rows else ()):
                wanted = np.zeros(len(counts), bool)
                wanted[own.probe(query, counts)] = True
                out = []
                for block in range(BLOCKS):
                    bits = wanted[block::BLOCKS]
                    if bits.any():
                        out += [(block, part, np.packbits(bits).tobytes()) for part in range(parts[block])]
                at = pa.array([i] * len(out), pa.int64())
                picked = batch.take(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), picked.column("query"),
                     picked.column("vector"), pa.array([o[2] for o in out], pa.binary())],
                    ["block", "part", "query", "vector", "cells"],
                )

    slices = max(1, -(-queries.count() // SLICE))
    sought = queries.select("vector", "query").mapInArrow(walk, f"block int, part int, query long, vector {kind}, cells binary")
    sought = sought.withColumn("slice", F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int"))
    spread = F.element_at(F.array(*(F.lit(p) for p in parts)), F.col("block") + 1)
    held = entries.withColumn("block", (F.col("cell") % BLOCKS).cast("int")).select(
        "block", F.pmod(F.xxhash64(F.col("ids")[0]), spread).cast("int").alias("part"), "vector", "ids", "cell"
    ).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def rank(key: tuple, asked: Iterator[pa.RecordBatch], there: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best entries of one part of a block for each query; parts and slices are bounded."""
        entries = pa.Table.from_batches(list(there)) if there is not None else None
        if entries is None or not entries.num_rows:
            return
        entries = entries.combine_chunks().to_batches()[0]
        ids = entries.column("ids")
        order = np.argsort([x[0] for x in ids.to_pylist()], kind="stable")
        vectors = _matrix(entries.column("vector"))[order]
        local = entries.column("cell").to_numpy()[order] // BLOCKS
        for batch in asked:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                scores = _matrix(part.column("vector")) @ vectors.T
                bits = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for b in part.column("cells").to_pylist()], bool)
                scores[~bits[:, local]] = -np.inf
                queries, picked, values = [], [], []
                top = min(k + 1, len(vectors))
                edge = -np.partition(-scores, top - 1, axis=1)[:, top - 1]
                for q in range(part.num_rows):
                    near = np.flatnonzero((scores[q] >= edge[q]) & (scores[q] > -np.inf))
                    near = near[np.argsort(-scores[q, near], kind="stable")][:top]
                    queries += [q] * len(near)
                    picked.append(near)
                    values.append(scores[q, near])
                at = np.concatenate(picked)
                yield pa.RecordBatch.from_arrays(
                    [part.column("query").take(pa.array(queries, pa.int64())), ids.take(pa.array(order[at])), pa.array(np.concatenate(values))],
                    ["query", "ids", "score"],
                )

    found = sought.groupBy("block", "part", "slice").cogroup(held.groupBy("block", "part", "slice")).applyInArrow(
        lambda key, a, b: _table(rank(key, a.to_batches(), b.to_batches())), "query long, ids array<long>, score double"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    found = found.select("query", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    named = asked.join(queries, "vector").select(F.col("id").alias("query_id"), "query")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    result = named.join(found, "query").where("query_id <> vec_id").withColumn("rank", F.row_number().over(last))
    return result.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    schema = pa.schema([("query", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])
    return pa.Table.from_batches([b.cast(schema) for b in batches], schema)


def op7_neighbours(embeddings: DataFrame) -> DataFrame:
    return neighbours(embeddings)
