"""Jaccard join on five-word shingles: banded candidates, Bayesian pruning, exact verification.

1. Texts with the same words are one class; only its smallest id goes on.
2. Two classes that share a band of MinHash values are candidates. Within a bucket their values are
   compared a few at a time, and a pair goes once the posterior probability that its similarity reaches
   the threshold is below a tolerance. Of what remains, a spanning forest per bucket is enough to know
   which classes may belong together: no list of pairs leaves a task.
3. Each group of connected classes is dealt once (a large one in pairs of blocks), and there the pairs
   that survive the same pruning are verified exactly on their shingles. Out come counts of links and
   roots, one row per class and block pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.arrow import flat_text, text_chunks
from streamlab.llm.components import components
from streamlab.llm.shingles import HASHES, minhashes, shingle_hashes
from streamlab.plans.lineage import cut_lineage

THRESHOLD = 0.8
#: A true pair is lost by the bands with probability (1 - 0.8^4)^32 = 5e-8 at the threshold, less above.
BANDS, BAND_ROWS = 32, 4
#: MinHash values that are compared before a pair may be dropped, and the posterior below which it is.
CHECKPOINTS, TOLERANCE = (16, 32, 64, 96, 128), 1e-9
#: Sizes of blocks. They cut large buckets and groups into tasks; every pair of blocks is worked on.
BUCKET_BLOCK, GROUP_DOCS, GROUP_BYTES = 20_000, 1024, 4 << 20


def least_matches(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest of ``n`` equal values with which a pair stays: P(similarity >= threshold | m of n), flat prior."""
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


LEAST = [(n, least_matches(n)) for n in CHECKPOINTS]


def survivors(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Rows of ``others`` that may be similar to ``one`` (or row by row, if ``one`` has as many rows)."""
    alive, matches, done = np.arange(len(others)), np.zeros(len(others), np.int16), 0
    for n, least in LEAST:
        if not len(alive):
            break
        left = one[alive, done:n] if one.ndim == 2 else one[done:n]
        matches = matches + (others[alive, done:n] == left).sum(axis=1, dtype=np.int16)
        stay = matches >= least
        alive, matches, done = alive[stay], matches[stay], n
    return alive


def _forest(ids: np.ndarray, values: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span what survives among the members of one bucket; ids ascend."""
    left, edges = np.arange(len(ids)), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            hit = survivors(values[queue.pop()], values[left])
            near = left[hit]
            edges += [(int(ids[x]), int(ids[root])) for x in near]
            queue += near.tolist()
            left = np.delete(left, hit)
    return edges


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of whole groups from sorted batches, each run as one table; the last group waits for its end."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        tail = np.ones(batch.num_rows, bool)
        for k in key:
            tail &= k == k[-1]
        cut = batch.num_rows - int(tail[::-1].argmin()) if not tail.all() else 0
        if waiting and not (cut == 0 and all(k[0] == waiting[-1].column(n)[-1].as_py() for k, n in zip(key, keys))):
            yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
            waiting = []
        elif cut:
            yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
            waiting = []
        waiting.append(batch.slice(cut))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        x = table.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, copy, signature): equal words give equal ``copy``; null where a text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches, "text"):
            hashes, starts = shingle_hashes(data, offsets)
            values = minhashes(hashes, starts)
            some = np.diff(starts) > 0
            copies = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array([c if s else None for c, s in zip(copies, some)], pa.binary()),
                    pa.array([v.tobytes() if s else None for v, s in zip(values, some)], pa.binary()),
                ],
                ["doc_id", "copy", "signature"],
            )

    picked = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, copy binary, signature binary")


def candidate_edges(classes: DataFrame) -> DataFrame:
    """(a, b) spanning what may be linked among classes (rep, signature)."""
    width = 2 * BAND_ROWS
    bands = classes.select(
        "rep",
        F.explode(
            F.array(*(F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(BANDS)))
        ).alias("bucket"),
    )
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BUCKET_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    members = bands.join(shared, "bucket").withColumn("blocks", blocks).withColumn("own", own)
    members = members.select(
        "rep", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("rep", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    keys = ["bucket", "i", "j"]
    dealt = members.join(classes, "rep").repartition(*keys).sortWithinPartitions(*keys, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, keys):
            ids = table.column("rep").to_numpy()
            flat = flat_text(table.column("signature").combine_chunks())[1]
            values = flat.view(np.uint16).reshape(-1, HASHES)
            bounds = _bounds(table, keys)
            sizes = np.diff(bounds)
            two = bounds[:-1][sizes == 2]
            hit = two[survivors(values[two], values[two + 1])]
            edges = list(zip(ids[hit + 1].tolist(), ids[hit].tolist()))
            for a, b in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2]):
                edges += _forest(ids[a:b], values[a:b])
            edges = sorted(set(edges))
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"]
            )

    return dealt.select("rep", *keys, "signature").mapInArrow(run, "a long, b long")


def _verify(ids: np.ndarray, copies: np.ndarray, side: np.ndarray, sets: list[np.ndarray], values: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """Linked documents of each class, and the smallest id that each is connected to, within one group."""
    n = len(ids)
    links, root = np.zeros(n, np.int64), np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets], np.int64)
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    flag = np.zeros(int(local.max()) + 1, bool)
    for x in range(n - 1):
        others = np.arange(x + 1, n)
        others = others[(side[others] != side[x]) if cross else slice(None)]
        ratio = np.minimum(sizes[others], sizes[x]) >= THRESHOLD * np.maximum(sizes[others], sizes[x]) - 1e-9
        others = others[ratio]
        others = others[survivors(values[x], values[others])]
        if not len(others):
            continue
        own = local[begin[x] : begin[x + 1]]
        flag[own] = True
        at = np.concatenate([local[begin[y] : begin[y + 1]] for y in others])
        common = np.add.reduceat(flag[at].astype(np.int64), np.concatenate(([0], np.cumsum(sizes[others])[:-1])))
        flag[own] = False
        near = others[5 * common >= 4 * (sizes[x] + sizes[others] - common)]  # common / union >= 0.8, exactly
        links[x] += copies[near].sum()
        links[near] += copies[x]
        for y in near:
            a, b = find(x), find(int(y))
            if a != b:
                root[max(a, b)] = min(a, b)
    return links, ids[[find(x) for x in range(n)]]


def _once(ids: np.ndarray, sets: list[np.ndarray]) -> list[int]:
    """Rows without those that repeat an id with the same shingles; ids ascend."""
    seen: set[tuple[int, bytes]] = set()
    same = np.concatenate(([False], ids[1:] == ids[:-1]))
    keep = []
    for k in range(len(ids)):
        if not same[k]:
            seen.clear()
        if same[k] or same[k + 1 : k + 2].any():
            key = (int(ids[k]), hashlib.blake2b(sets[k].tobytes()).digest())
            if key in seen:
                continue
            seen.add(key)
        keep.append(k)
    return keep


def verified(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """(rep, links, root, many): exact links of classes within their group.

    ``texts`` has (rep, text, copies) of every class, ``groups`` (node, root) of those that may be linked.
    """
    dealt = texts.join(groups.withColumnRenamed("root", "grp"), texts["rep"] == groups["node"]).drop("node")
    sizes = dealt.groupBy("grp").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / GROUP_DOCS), F.ceil(F.col("bytes") / GROUP_BYTES), F.lit(1)).cast("int")
    dealt = dealt.join(sizes.select("grp", blocks.alias("blocks")), "grp").withColumn(
        "side", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select(
        "grp", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "rep", "copies", "side", "text", "blocks"
    )
    keys = ["grp", "i", "j"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, keys):
            bounds = _bounds(table, keys)
            out: list[list] = [[], [], [], []]
            for a, b in zip(bounds[:-1], bounds[1:]):
                part = table.slice(a, b - a)
                ids, side, copies = (part.column(c).to_numpy() for c in ("rep", "side", "copies"))
                offsets, data = flat_text(part.column("text").combine_chunks())
                hashes, starts = shingle_hashes(data, offsets)
                sets = [np.unique(hashes[x:y]) for x, y in zip(starts[:-1], starts[1:])]
                values, once = minhashes(hashes, starts), _once(ids, sets)
                ids, side, copies, values, sets = ids[once], side[once], copies[once], values[once], [sets[k] for k in once]
                cross = part.column("i")[0].as_py() != part.column("j")[0].as_py()
                links, root = _verify(ids, copies, side, sets, values, cross)
                for column, x in zip(out, (ids, links, root, [part.column("blocks")[0].as_py() > 1] * len(ids))):
                    column.extend(x)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["rep", "links", "root", "many"])

    return dealt.mapInArrow(run, "rep long, links long, root long, many boolean")


def ngram_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, copy_of) of every row.

    ``n_links`` counts the other rows with similarity of 0.8 or more, ``class_id`` is the smallest id that
    links lead to, ``copy_of`` the smallest id with the same words. A null or empty text has no shingles: it
    has no links and is its own class. Rows that repeat an id are copies of each other if their words
    are equal; with different words, where no smaller id has either, they count as one document that has the
    links of both, and it has as many copies as the more frequent of its texts. A row without an id keeps
    null, unless a row with the same words has one. Other columns are left out.
    """
    base = cut_lineage(signatures(df, id_col, text_col), "signatures")
    copies = base.where("copy is not null").groupBy("copy").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    members = base.join(copies, "copy", "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies"))
    classes = base.join(copies, "copy").where(F.col("doc_id") == F.col("rep")).select("rep", "copies", "signature")
    classes = cut_lineage(classes.dropDuplicates(["rep", "signature"]), "classes")
    groups = components(candidate_edges(classes.select("rep", "signature")))
    texts = df.select(F.col(id_col).cast("long").alias("rep"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = classes.groupBy("rep").agg(F.max("copies").alias("copies"))
    texts = texts.join(counts.join(groups, F.col("rep") == F.col("node"), "left_semi"), "rep").distinct()
    found = cut_lineage(verified(texts, groups), "verified")
    roots = found.groupBy("rep").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    if not found.where("many").isEmpty():
        wide = components(found.where("many").select(F.col("rep").alias("a"), F.col("root").alias("b")))
        roots = roots.join(wide.select(F.col("node").alias("rep"), F.col("root").alias("wide")), "rep", "left").select(
            "rep", "links", F.coalesce("wide", "root").alias("root")
        )
    return members.join(roots, "rep", "left").select(
        "doc_id",
        F.coalesce("root", "rep").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.col("rep").alias("copy_of"),
    )


#: The same rows in DuckDB: shingle sets as lists, shared shingles counted, classes by reachability.
ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\t\n\f\r ]+'), lambda x: x <> '') AS w FROM documents
), grams AS (
  SELECT doc_id, array_to_string(w, ' ') AS same, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM words
), sets AS (SELECT DISTINCT doc_id, g FROM grams), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), copies AS (
  SELECT min(doc_id) AS rep, array_to_string(w, ' ') AS same FROM words WHERE len(w) > 0 GROUP BY 2
)
SELECT w.doc_id, least(w.doc_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = w.doc_id), w.doc_id)) AS class_id,
  (SELECT count(*) FROM links l WHERE l.a = w.doc_id) AS n_links, coalesce(c.rep, w.doc_id) AS copy_of
FROM words w LEFT JOIN copies c ON len(w.w) > 0 AND c.same = array_to_string(w.w, ' ')
"""


def op9_join(docs: DataFrame) -> DataFrame:
    return ngram_join(docs)
