"""Quality by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. Of a pair of labelled documents, the one with
label 1 wins with probability sigmoid(difference of strengths); the weights minimise the logistic loss
on feature differences. A document passes where its strength is above a quantile of the strengths of all documents.
The quantile is the share of label 0 among all documents: the share that a cut through the labelled ones puts
below it, corrected by what that cut gets wrong among them (a difference estimator).
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.llm.arrow import text_chunks
from streamlab.plans.lineage import cut_lineage

#: Labelled documents of each class that the model may see: a bound for the driver's memory, not for scoring.
SAMPLE_PER_CLASS = 4000
#: Scores at least this high pass.
CUT = 0.7
#: Width of the bins in which strengths are counted for their quantile.
BIN = 1 / 256
PAIRS_PER_STEP, STEPS, RATE, DECAY = 2048, 400, 0.03, 1e-3


def _byte_classes() -> np.ndarray:
    """Letters by case, digits and non-ASCII bytes share a class each; every other ASCII sign has its own."""
    classes, spare = np.zeros(256, np.int64), iter(range(5, 256))
    for b in range(128):
        c = chr(b)
        kind = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if b < 32 and c not in "\n\t" or b == 127 else None
        classes[b] = next(spare) if kind is None else kind
    classes[128:] = 4
    return classes


CLASSES = _byte_classes()
N_CLASSES = int(CLASSES.max()) + 1
N_FEATURES = N_CLASSES + N_CLASSES**2 + 6


def text_features(texts: list[str], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: shares of byte classes and of their pairs, word lengths and repetition."""
    n = len(texts)
    out = np.zeros((n, N_FEATURES), np.float32)
    kind, sizes = CLASSES[data], np.diff(offsets)
    doc = np.repeat(np.arange(n), sizes)
    total = np.maximum(sizes, 1)[:, None]
    out[:, :N_CLASSES] = np.bincount(doc * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, -1) / total
    if len(data) > 1:
        inside = doc[1:] == doc[:-1]
        pair = (doc[1:] * N_CLASSES + kind[:-1]) * N_CLASSES + kind[1:]
        counts = np.bincount(pair[inside], minlength=n * N_CLASSES**2).reshape(n, -1)
        out[:, N_CLASSES : N_CLASSES + N_CLASSES**2] = counts / total
    for i, text in enumerate(texts):
        words, lines = text.split(), text.split("\n")
        k = max(len(words), 1)
        out[i, -6:] = (
            np.log1p(len(words)),
            len(text) / k,
            len(set(words)) / k,
            sum(map(eq, words, words[1:])) / k,
            len(set(lines)) / len(lines),
            len(set(words)) / k**0.8,
        )
    return out


class BradleyTerry(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strengths(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -6, 6)
        return (z.astype(np.float64) * self.weights).sum(axis=1)  # row by row: the same in any batch


class Fitted(NamedTuple):
    """A model whose threshold is a cut through its own sample, and the share of label 0 less the share below that cut."""

    model: BradleyTerry
    correction: float


def fit_bradley_terry(features: np.ndarray, labels: np.ndarray, share_of_zero: float, seed: int = 7) -> Fitted:
    """Weights from random pairs of a better and a worse document (Adam on the logistic loss).

    With one class only there are no pairs: every strength is 0, and all are above the cut or none is.
    """
    mean = features.mean(axis=0) if len(features) else np.zeros(N_FEATURES, np.float32)
    scale = features.std(axis=0) if len(features) else np.ones(N_FEATURES, np.float32)
    scale = np.where(scale > 1e-9, scale, 1).astype(np.float32)
    weights = np.zeros(features.shape[1], np.float32)
    better, worse = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(better) or not len(worse):
        return Fitted(BradleyTerry(mean, scale, weights, -1.0 if share_of_zero < 0.5 else 1.0), 0.0)
    z = np.clip((features - mean) / scale, -6, 6)
    rng = np.random.default_rng(seed)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        diff = z[rng.choice(better, PAIRS_PER_STEP)] - z[rng.choice(worse, PAIRS_PER_STEP)]
        lost = 1 / (1 + np.exp(np.clip(diff @ weights, -50, 50)))
        gradient = DECAY * weights - diff.T @ lost / PAIRS_PER_STEP
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = weights - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model = BradleyTerry(mean, scale, weights, 0.0)
    strengths = model.strengths(features)
    weight = np.where(labels == 1, (1 - share_of_zero) / len(better), share_of_zero / len(worse))
    cut = _cut(strengths, weight, share_of_zero)
    return Fitted(model._replace(threshold=cut), share_of_zero - float(weight[strengths < cut].sum()))


def _cut(strengths: np.ndarray, weight: np.ndarray, share: float) -> float:
    """Where ``share`` of the weight lies below, between two strengths of the sample."""
    order = np.argsort(strengths, kind="stable")
    at = int(np.searchsorted(np.cumsum(weight[order]), share - 1e-12))
    s = strengths[order]
    return float((s[min(at, len(s) - 1)] + s[min(at + 1, len(s) - 1)]) / 2)


def quantile_of_bins(bins: list[tuple[int, int]], cut: float, correction: float = 0.0) -> float:
    """The quantile of all strengths, from (bin, rows), at the share of rows below ``cut`` plus ``correction``.

    It lies in the middle between two bins that have rows. With a share of 0 all strengths are above it, with 1 none is.
    """
    if not bins:
        return cut
    at, n = (np.array(x, np.int64) for x in zip(*sorted(bins)))
    below = np.cumsum(n)
    share = int(n[(at + 1) * BIN <= cut].sum()) + correction * int(below[-1])
    k = int(np.searchsorted(below, round(share), side="right"))  # bins that lie below as a whole
    if k == 0:
        return float((at[0] - 1) * BIN)
    return float((at[k - 1] + 1 + (at[k] if k < len(at) else at[-1] + 1)) / 2 * BIN)


def threshold_of(strengths: DataFrame, fitted: Fitted, strength_col: str = "strength") -> float:
    """The quantile over all rows. Counts per bin merge exactly and in any order; their number follows from the
    weights (features are cut at 6 deviations), not from the rows."""
    counts = strengths.groupBy(F.floor(F.col(strength_col) / BIN).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return quantile_of_bins([(r["bin"], r["n"]) for r in counts.collect()], fitted.model.threshold, fitted.correction)


def labelled(df: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled documents of each class, and the number of labels of each.

    Only rows of ``labels`` for which ``keep`` holds are used, contradicting or repeated labels once by
    their largest value. The list of ids has at most two times ``per_class`` rows: it may be broadcast.
    """
    known = labels.where(keep & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = [known.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    ids = few[0].unionByName(few[1]).withColumnRenamed("doc_id", "_labelled")
    picked = df.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_labelled"))
    return picked.select("doc_id", "text", "label"), counts


def train_weights(df: DataFrame, labels: DataFrame, keep: Column, per_class: int = SAMPLE_PER_CLASS) -> Fitted:
    """Fit on labelled documents for whose label rows ``keep`` holds."""
    sample, counts = labelled(df, labels, "quality", keep, per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches, "text"):
            features = text_features([t or "" for t in rows.column("text").to_pylist()], data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.string()), rows.column("label"), pa.array([f.tobytes() for f in features], pa.binary())],
                ["doc_id", "label", "features"],
            )

    rows = sample.mapInArrow(run, "doc_id string, label int, features binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    # Copies of a document (a repeated id) may exceed the bound on ids; the model sees each id once.
    rows = [r for i, r in enumerate(rows) if not i or r["doc_id"] != rows[i - 1]["doc_id"]]
    features = np.array([np.frombuffer(r["features"], np.float32) for r in rows], np.float32).reshape(-1, N_FEATURES)
    total = sum(counts.values())
    return fit_bradley_terry(features, np.array([r["label"] for r in rows], np.int64), counts.get(0, 0) / total if total else 0.0)


def train_quality(df: DataFrame, labels: DataFrame, keep: Column, per_class: int = SAMPLE_PER_CLASS) -> BradleyTerry:
    """Weights from labelled documents, and the threshold from the strengths of all rows of ``df``: two passes over texts."""
    fitted = train_weights(df, labels, keep, per_class)
    return fitted.model._replace(threshold=threshold_of(with_strength(df.select("text"), fitted.model), fitted))


def with_strength(df: DataFrame, model: BradleyTerry, text_col: str = "text", strength_col: str = "strength") -> DataFrame:
    """All columns and rows, and the strength of each whole text; a column of that name is replaced.

    A null text has the strength of an empty one. No shuffle, one pass. The model has a fixed size.
    """
    shared = df.sparkSession.sparkContext.broadcast(tuple(model))
    if strength_col in df.columns:
        df = df.drop(strength_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = BradleyTerry(*shared.value)
        for rows, data, offsets in text_chunks(batches, text_col):
            found = own.strengths(text_features([t or "" for t in rows.column(text_col).to_pylist()], data, offsets))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found)], [*rows.schema.names, strength_col])

    schema = df.select("*").withColumn(strength_col, F.lit(0.0)).schema
    return df.mapInArrow(run, schema)


def score_of(strength: Column, threshold: float) -> Column:
    """0 to 1, rising with the strength, and ``CUT`` at the threshold."""
    above = F.greatest(F.least(strength - F.lit(threshold), F.lit(500.0)), F.lit(-500.0))
    return 1 / (1 + F.exp(-above) * ((1 - CUT) / CUT))


def with_quality(df: DataFrame, model: BradleyTerry, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and rows, and the score of each whole text; a column of that name is replaced."""
    return with_strength(df, model, text_col, score_col).withColumn(score_col, score_of(F.col(score_col), model.threshold))


def bucket(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op8_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; labels are learned only where the remainder by 4 is not 2.

    Texts are read once for their strengths, which are written; threshold and scores come from that table.
    """
    picked = docs.select("doc_id", "text")
    fitted = train_weights(picked, labels, bucket(4) != 2)
    found = cut_lineage(with_strength(picked, fitted.model).select("doc_id", "strength"), "strengths")
    return found.select(
        "doc_id",
        F.coalesce(bucket(4) == 2, F.lit(False)).alias("held_out"),
        score_of(F.col("strength"), threshold_of(found, fitted)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
