"""Hard negatives: for an anchor and each of its positives, wrong-label rows whose score lies in a window below.

Vectors become integers, so that scores are exact. Anchors and candidates are dealt in blocks; a pair of
blocks is multiplied in int64 tiles by Strassen's recursion, with zero rows or columns where a side is
odd. A tile pushes what it finds onto small heaps, one per anchor (positives) or per anchor and positive
(negatives in the window); heaps of different tiles merge into the heap of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.plans.lineage import cut_lineage

#: Rows of a block of anchors and of candidates: bounds for a task, whatever the table's size.
ANCHORS, CANDIDATES = 16_384, 32_768
#: Rows of a tile, whose scores are in memory at a time (16 MB).
TILE_ANCHORS, TILE_CANDIDATES = 256, 8_192
#: A side no longer than this is multiplied plainly.
LEAF = 16
#: A vector's squared length must stay below this, so that 100 times any score is a 64-bit number.
LONGEST = 2.0**56
NOTHING = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` for int64, in seven products of halves; odd sides get a row or column of zeros."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    out = np.zeros((2 * i, 2 * h), np.int64)
    top_left, top_right, low_left, low_right = out[:i, :h], out[:i, h:], out[i:, :h], out[i:, h:]
    p = strassen(a11 + a22, b11 + b22)
    top_left += p
    low_right += p
    p = strassen(a21 + a22, b11)
    low_left += p
    low_right -= p
    p = strassen(a11, b12 - b22)
    top_right += p
    low_right += p
    p = strassen(a22, b21 - b11)
    top_left += p
    low_left += p
    p = strassen(a11 + a12, b22)
    top_left -= p
    top_right += p
    low_right += strassen(a21 - a11, b11 + b12)
    top_left += strassen(a12 - a22, b21 + b22)
    return out[:m, :n]


class Heaps:
    """A heap of the ``size`` best (score, smaller id first) for each of some keys."""

    def __init__(self, size: int):
        self.size = size
        self.held: dict[object, list[tuple[int, int]]] = {}

    def push(self, key: object, score: int, row: int) -> None:
        heap = self.held.setdefault(key, [])
        if len(heap) < self.size:
            heappush(heap, (score, -row))
        else:
            heappushpop(heap, (score, -row))

    def push_tile(self, keys: list, scores: np.ndarray, rows: np.ndarray) -> None:
        """Row i of ``scores`` belongs to ``keys[i]``, column j to ``rows[j]`` (ascending); ``NOTHING`` is no entry."""
        n = scores.shape[1]
        if n > self.size:
            edge = np.partition(scores, n - self.size, axis=1)[:, n - self.size, None]
            at, column = np.nonzero((scores >= edge) & (scores > NOTHING))
        else:
            at, column = np.nonzero(scores > NOTHING)
        found = scores[at, column]
        order = np.lexsort((column, -found, at))
        at, column, found = at[order], column[order], found[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        best = place < self.size
        for i, score, row in zip(at[best].tolist(), found[best].tolist(), rows[column[best]].tolist()):
            self.push(keys[i], score, row)

    def rows(self) -> Iterator[tuple[object, int, int]]:
        for key, heap in self.held.items():
            for score, row in heap:
                yield key, -row, score


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as whole numbers, floor(256 * x); rows that cannot take part are left out."""
    for batch in batches:
        vectors = batch.column("vector")
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        of = np.repeat(np.arange(batch.num_rows), lengths)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(256 * x)
            squared = np.bincount(of, weights=x * x, minlength=batch.num_rows)
        fine = squared < LONGEST  # false for NaN as well
        codes = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(lengths[fine]))), pa.int32()), pa.array(x[fine[of]].astype(np.int32))
        )
        kept = batch.filter(pa.array(fine))
        yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("label"), codes], ["id", "label", "codes"])


def coded_rows(df: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, codes): one row per id that takes part; of a repeated id the smallest (label, codes)."""
    used = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector")
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    codes = used.mapInArrow(_codes, "id long, label long, codes array<int>")
    best = codes.groupBy("id").agg(F.min(F.struct("label", "codes")).alias("r"))
    return best.select("id", "r.label", "r.codes")


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("codes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(table.num_rows, -1)


def _tiles(anchors: pa.Table, candidates: pa.Table) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors' slice, scores, candidates' ids, candidates' labels); candidates come in the order of their ids."""
    candidates = candidates.sort_by("id")
    asked, ids, labels = _matrix(anchors), _numbers(candidates, "id"), _numbers(candidates, "label")
    for lo in range(0, candidates.num_rows, TILE_CANDIDATES):
        right = _matrix(candidates.slice(lo, TILE_CANDIDATES)).T
        for at in range(0, len(asked), TILE_ANCHORS):
            part = slice(at, at + TILE_ANCHORS)
            scores = strassen(asked[part], right)
            yield part, scores, ids[lo : lo + TILE_CANDIDATES], labels[lo : lo + TILE_CANDIDATES]


def _pairs(columns: dict[str, list]) -> pa.Table:
    return pa.table({name: pa.array(values, pa.int64()) for name, values in columns.items()})


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")


def _copies(df: DataFrame, name: str, blocks: int) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def hard_negatives(
    df: DataFrame,
    anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), whole and exact.

    ``anchor`` is a condition on ``id`` (by default: divisible by 50). A row's score is its integer inner
    product with the anchor, with floor(256 * x) for x; higher scores come first, ties by smaller id. The
    positives of an anchor are its first rows of the same label; a pair's negatives are the first rows of
    other labels whose score is between the two percentages of the positive's score.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part; nor
    do vectors whose integers have a squared length of 2^56 or more (their scores would not fit), nor
    vectors of another length than that of the smallest id. Vectors may be zero or empty. Of rows that
    repeat an id the smallest (label, codes) counts. Anchors without a positive, and pairs without a
    negative, have no rows; nor has an empty table. Other columns are left out.
    """
    low, high = window
    rows = cut_lineage(coded_rows(df, id_col, label_col, vector_col), "coded")
    wanted = F.col("id") % 50 == 0 if anchor is None else anchor
    length, n, asking = rows.agg(F.min_by(F.size("codes"), "id"), F.count(F.lit(1)), F.count_if(wanted)).first()
    rows = rows.where(F.size("codes") == F.lit(length))
    spread = max(-(-n // CANDIDATES), df.sparkSession.sparkContext.defaultParallelism)
    blocks = max(-(-asking // ANCHORS), 1)
    anchors = rows.where(wanted).withColumn("block", _block(blocks))
    candidates = _copies(rows.withColumn("part", _block(spread)), "block", blocks)

    def nearest(key: tuple, asked: pa.Table, there: pa.Table) -> pa.Table:
        """Heaps of the best rows of the anchor's label in one part."""
        heaps, ids = Heaps(positives), _numbers(asked, "id")
        if asked.num_rows and there.num_rows:
            for part, scores, rows_, _ in _tiles(asked, there):
                scores[ids[part, None] == rows_] = NOTHING
                heaps.push_tile(ids[part].tolist(), scores, rows_)
        out = list(heaps.rows())
        return _pairs({"anchor_id": [r[0] for r in out], "positive_id": [r[1] for r in out], "positive_score": [r[2] for r in out]})

    keys = ["label", "block", "part"]
    near = _copies(anchors, "part", spread).groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        nearest, "anchor_id long, positive_id long, positive_score long"
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    chosen = near.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list("positive_id").alias("ids"), F.collect_list("positive_score").alias("scores")
    )
    paired = cut_lineage(anchors.join(chosen, "id"), "positives")

    def in_window(key: tuple, asked: pa.Table, there: pa.Table) -> pa.Table:
        """Heaps of the best rows of other labels in one part, for each anchor and positive."""
        heaps = Heaps(negatives)
        if asked.num_rows and there.num_rows:
            ids, own = _numbers(asked, "id"), _numbers(asked, "label")
            found = list(zip(ids.tolist(), asked.column("ids").to_pylist(), asked.column("scores").to_pylist()))
            for part, scores, rows_, labels in _tiles(asked, there):
                scores[own[part, None] == labels] = NOTHING
                pairs = [(i, at, p, s) for i, (at, ps, ss) in enumerate(found[part]) for p, s in zip(ps, ss)]
                for lo in range(0, len(pairs), TILE_ANCHORS):
                    some = pairs[lo : lo + TILE_ANCHORS]
                    score = np.array([x[3] for x in some], np.int64)[:, None]
                    seen = scores[[x[0] for x in some]]
                    # 100 * seen in the window, without forming a product of NOTHING
                    seen[(seen > high * score // 100) | (seen < -(-low * score // 100))] = NOTHING
                    heaps.push_tile([x[1:] for x in some], seen, rows_)
        out = list(heaps.rows())
        return _pairs({
            "anchor_id": [r[0][0] for r in out], "positive_id": [r[0][1] for r in out], "positive_score": [r[0][2] for r in out],
            "negative_id": [r[1] for r in out], "negative_score": [r[2] for r in out],
        })

    keys = ["block", "part"]
    hard = _copies(paired, "part", spread).groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        in_window, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        hard.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op11_negatives(embeddings: DataFrame) -> DataFrame:
    """The contract's label: every seventh id takes the next of ten labels."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.select("vec_id", moved.alias("label"), "embedding"))


ORACLE = """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM r a JOIN r b ON a.id % 50 = 0 AND a.id <> b.id
), p AS (
  SELECT anchor, other AS positive, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
), n AS (
  SELECT p.anchor, p.positive, p.score AS positive_score, s.other, s.score,
    row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other) AS k
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor AS anchor_id, positive AS positive_id, k::INTEGER AS rank, other AS negative_id, positive_score,
  score AS negative_score
FROM n WHERE k <= 3
"""
