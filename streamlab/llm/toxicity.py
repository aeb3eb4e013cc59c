"""Toxicity by a support vector machine on a subsequence string kernel with Nystroem landmarks.

The kernel of two words is the inner product of their gap-weighted subsequences: every way to read three
or four letters of a word in order counts with DECAY to the power of the stretch it covers, so an insult
with another ending, with letters put in, or with signs between its letters stays close to the insult.
Landmarks are words of the labelled sentences. Nystroem features are linear in the kernel, so once the
machine is trained its weights fold into one table over subsequences, and scoring a word is a sum.

The margin of a sentence is that of its worst word. Labels are known by document only, so the machine is
trained on sentences as multiple instances: a clean document's sentences must all lie below the margin, of a
toxic one its worst sentence must lie above. The first machine learns from the words that mark toxic
documents; later ones from the witnesses that the one before finds. A document is scored by its sentences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.llm.arrow import mix, text_chunks
from streamlab.llm.quality import CUT, bucket, labelled
from streamlab.plans.lineage import cut_lineage

#: Bounds on what is fitted on the driver: documents of each class, words of each class, landmarks.
SAMPLE_PER_CLASS, WORDS_PER_CLASS, LANDMARKS = 4000, 3000, 300
#: Words that a task remembers; memory only.
CACHE_WORDS = 400_000
#: Letters whose subsequences are held at a time; memory only.
LETTERS_AT_ONCE = 50_000
DECAY, STRETCH = 0.7, 6
#: Of the most telling word's gain, where no word beats chance.
LEAST_SHARE = 2 / 3
PENALTY = 3e-5
BITS = 18
SIZE = 1 << BITS
#: Positions of a subsequence, counted from its first letter.
READINGS = [(0, *rest) for k in (2, 3) for rest in combinations(range(1, STRETCH), k)]
#: Lengths of the beginnings of words that are counted like words: one insult has many endings.
STEMS = (4, 5, 6)
#: Single letters in a row (i d i o t) are one word.
SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_]\s){2,}[^\W\d_](?!\S)")
NOT_LETTER = re.compile(r"[\W\d_]+")
#: A sentence ends with its line or with a word that this finds.
SENTENCE_END = re.compile(r"[.!?|\u2026\u3002\uff01\uff1f][\"'\u2019\u201d)\]]*$")
#: Times that witnesses are sought anew; margins at which a toxic document's worst sentence is one, and any other word of it.
ROUNDS, WITNESS, SURE = 2, 0.3, 0.5
#: Margins at which a document's sentences are counted.
LEVELS = np.array([-0.5, 0.0, 0.5, 1.0])
N_DOC = 2 + 2 * len(LEVELS)


def letters(word: str) -> str:
    """The word's letters in lower case; digits and signs inside it count as inserted."""
    return word.lower() if word.isalpha() else NOT_LETTER.sub("", word.lower())


def _subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence code, weight) of every reading; words are marked at both ends."""
    text = "".join(f"\x01{w}\x02" for w in words)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), np.array([len(w) + 2 for w in words], np.int64))
    found = []
    for reading in READINGS:
        n = len(code) - reading[-1]
        if n <= 0:
            continue
        key = np.zeros(n, np.uint64)
        for p in reading:
            key = key * np.uint64(0x9E3779B97F4A7C15) + code[p : p + n] + np.uint64(1)
        same = owner[:n] == owner[reading[-1] :]
        found.append((owner[:n][same], (mix(key[same]) >> np.uint64(64 - BITS)).astype(np.int64), np.full(int(same.sum()), DECAY ** (reading[-1] + 1), np.float32)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    return tuple(np.concatenate(x) for x in zip(*found))


def _norms(words: list[str], owner: np.ndarray, code: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Square root of each word's kernel with itself; codes that a word has twice are summed first."""
    key = owner * SIZE + code
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    summed = np.add.reduceat(weight, begin) if len(key) else weight
    return np.sqrt(np.bincount(key[begin] // SIZE, weights=summed.astype(np.float64) ** 2, minlength=len(words)))


class StringMachine(NamedTuple):
    """Weights of subsequences, the machine's bias, and the document's logistic weights."""

    table: np.ndarray
    bias: float
    doc_mean: np.ndarray
    doc_weights: np.ndarray
    doc_bias: float

    def margins(self, words: list[str]) -> np.ndarray:
        """The machine's decision for each word of letters; one without a subsequence has the bias."""
        out, begin, size = np.empty(len(words), np.float32), 0, 0
        for end, word in enumerate(words, 1):
            size += len(word) + 2
            if size >= LETTERS_AT_ONCE or end == len(words):
                out[begin:end] = self._margins(words[begin:end])
                begin, size = end, 0
        return out

    def _margins(self, words: list[str]) -> np.ndarray:
        owner, code, weight = _subsequences(words)
        sums = np.bincount(owner, weights=self.table[code] * weight, minlength=len(words))
        norms = _norms(words, owner, code, weight)
        return (sums / np.where(norms > 0, norms, 1) + self.bias).astype(np.float32)

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.doc_mean) * self.doc_weights).sum(axis=1) + self.doc_bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)) * (1 - CUT) / CUT)


class Scorer:
    """Margins of documents' sentences and features of documents from them; margins of words met before are kept."""

    def __init__(self, machine: StringMachine):
        self.machine = machine
        self.forget()

    def forget(self) -> None:
        self.index = _Words()
        self.margins = np.zeros(0, np.float32)
        self.ends = np.zeros(0, bool)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, the text of each word, the sentence of each word, and the first word of each sentence."""
        if len(self.index) > CACHE_WORDS:
            self.forget()
        look, found, lines, at = self.index.__getitem__, [], [], 0
        sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            for words in sentence_lines(text):
                lines.append(at)
                found.append(np.fromiter(map(look, words), np.int64, len(words)))
                at += len(words)
                sizes[i] += len(words)
        if self.index.new:
            new, self.index.new = self.index.new, []
            self.margins = np.concatenate((self.margins, self.machine.margins(list(map(letters, new)))))
            self.ends = np.concatenate((self.ends, np.fromiter((bool(SENTENCE_END.search(w)) for w in new), bool, len(new))))
        ids = np.concatenate(found) if found else np.zeros(0, np.int64)
        begins = np.zeros(len(ids), bool)
        begins[lines] = True
        begins[1:] |= self.ends[ids[:-1]]
        return ids, np.repeat(np.arange(len(texts)), sizes), np.cumsum(begins) - 1, np.flatnonzero(begins)

    def features(self, texts: list[str]) -> np.ndarray:
        ids, doc, _, starts = self.read(texts)
        sizes = np.bincount(doc, minlength=len(texts))
        worst = np.maximum.reduceat(self.margins[ids], starts) if len(ids) else np.zeros(0, np.float32)
        owner = doc[starts]
        out = np.zeros((len(texts), N_DOC))
        top = np.full(len(texts), -1.0)
        np.maximum.at(top, owner, worst)
        out[:, 0] = np.minimum(top, 1.2)
        out[:, 1] = np.log1p(sizes)
        for k, level in enumerate(LEVELS):
            count = np.bincount(owner[worst > level], minlength=len(texts))
            out[:, 2 + 2 * k] = np.log1p(count)
            out[:, 3 + 2 * k] = np.log1p(100 * count / np.maximum(sizes, 1))
        return out

    def witnesses(self, texts: list[str], labels: list[int]) -> list[tuple[str, int, float]]:
        """(word, label, margin), a word once a document.

        Of a clean document the worst word of each sentence; of a toxic one that of its worst sentence and all that are
        as surely toxic.
        """
        ids, doc, sentence, starts = self.read(texts)
        if not len(ids):
            return []
        margin = self.margins[ids]
        worst = np.maximum.reduceat(margin, starts)
        hit = np.flatnonzero(margin == worst[sentence])
        first = hit[np.unique(sentence[hit], return_index=True)[1]]  # of equal words the first
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, doc, margin)
        toxic = np.array(labels)[doc] == 1
        leading = np.zeros(len(ids), bool)
        leading[first] = (~toxic | (worst[sentence] == top[doc]) & (margin > WITNESS))[first]
        chosen = np.flatnonzero(leading | toxic & (margin > SURE))
        names = list(self.index)
        found = {(int(doc[i]), letters(names[ids[i]])): float(margin[i]) for i in chosen}
        return [(word, labels[d], m) for (d, word), m in found.items() if word]


class _Words(dict):
    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def sentence_lines(text: str) -> list[list[str]]:
    """White-space delimited words of each line that has any; letters that stand alone in a row are joined."""
    if SPELLED.search(text):
        text = SPELLED.sub(lambda m: "".join(m.group().split()), text)
    return [words for line in text.split("\n") if (words := line.split())]


def _fit_words(toxic: list[tuple[str, float]], clean: list[tuple[str, float]], seed: int = 5) -> tuple[np.ndarray, float]:
    """Squared hinge loss on Nystroem features of the words, by Newton's steps; folded weights and bias."""
    if not toxic:
        return np.zeros(SIZE, np.float32), -1.0
    rng = np.random.default_rng(seed)
    half = LANDMARKS // 2
    marks = [w for w, _ in toxic[:half]] + [clean[i][0] for i in rng.permutation(len(clean))[: LANDMARKS - half]]
    words = [w for w, _ in toxic] + [w for w, _ in clean]
    share = np.array([x for _, x in toxic] + [x for _, x in clean])
    sign = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    share[sign > 0] /= share[sign > 0].sum()
    if len(clean):
        share[sign < 0] /= share[sign < 0].sum()
    used, marks_rows = np.unique(_subsequences(marks)[1], return_inverse=True)
    owner, code, weight = _subsequences(marks)
    dense = np.zeros((len(marks), len(used)))
    np.add.at(dense, (owner, marks_rows), weight)
    norm = np.linalg.norm(dense, axis=1)
    dense /= np.where(norm > 0, norm, 1)[:, None]
    values, vectors = np.linalg.eigh(dense @ dense.T)
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    owner, code, weight = _subsequences(words)
    norms = _norms(words, owner, code, weight)
    column = np.minimum(np.searchsorted(used, code), len(used) - 1)
    hit = used[column] == code
    kernel = np.zeros((len(words), len(marks)))
    for lo in range(0, len(words), 500):
        part = hit & (owner >= lo) & (owner < lo + 500)
        x = np.zeros((min(500, len(words) - lo), len(used)))
        np.add.at(x, (owner[part] - lo, column[part]), weight[part])
        kernel[lo : lo + len(x)] = x @ dense.T
    z = np.hstack([kernel / np.where(norms > 0, norms, 1)[:, None] @ root, np.ones((len(words), 1))])
    share /= 1 + bool(len(clean))  # both classes weigh the same
    ridge = PENALTY * np.diag([1.0] * (z.shape[1] - 1) + [0.0]) + 1e-9 * np.eye(z.shape[1])
    w, inside = np.zeros(z.shape[1]), np.ones(len(z), bool)
    for _ in range(50):
        # Squared hinge loss: a least-squares step over the examples within the margin, until they stay the same.
        own = z[inside] * share[inside, None]
        w = np.linalg.solve(own.T @ z[inside] + ridge, own.T @ sign[inside])
        before, inside = inside, sign * (z @ w) < 1
        if (inside == before).all():
            break
    table = np.zeros(SIZE, np.float32)
    table[used] = dense.T @ (root @ w[:-1])
    return table, float(w[-1])


def _fit_documents(features: np.ndarray, labels: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic weights of the document features, classes weighted as they occur; the cut is put at ``CUT``."""
    if len(set(labels.tolist())) < 2:
        return np.zeros(N_DOC), np.zeros(N_DOC), -4.0
    mean = features.mean(axis=0)
    z = np.hstack([features - mean, np.ones((len(features), 1))])
    weight = np.where(labels == 1, prior / (labels == 1).sum(), (1 - prior) / (labels == 0).sum())
    penalty = np.diag([1e-5] * N_DOC + [1e-9])
    w = np.zeros(N_DOC + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - labels)) + penalty @ w
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(N_DOC + 1)
        step = np.linalg.solve(bend, gradient)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return mean, w[:-1], float(w[-1])


def train_toxicity(df: DataFrame, labels: DataFrame, keep: Column, per_class: int = SAMPLE_PER_CLASS) -> StringMachine:
    """Fit on labelled documents for whose label rows ``keep`` holds.

    Spark counts the documents of each class that have a word or its stem. Words that the toxic class explains better than
    chance (by the logarithm of the number of words, or as well as two thirds of the best word) train the first machine against words of clean documents. Then
    the sentences of all sampled documents are scored, and their witnesses train the next one.
    Without labels of both classes no text is toxic.
    """
    sample, counts = labelled(df, labels, "toxic", keep, per_class)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in text_chunks(batches, "text"):
            for text, label in zip(rows.column("text").to_pylist(), rows.column("label").to_pylist()):
                words = {letters(w) for line in sentence_lines(text or "") for w in line} - {""}
                own = sorted(words | {w[:k] for w in words for k in STEMS if len(w) > k})
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([label] * len(own), pa.int32())], ["word", "label"])

    # An exact copy of a document says nothing new. The sample is read several times.
    sample = cut_lineage(sample, "toxicity-sample")
    once = sample.groupBy(F.xxhash64("text").alias("copy"), "label").agg(F.min("text").alias("text")).select("text", "label")
    once = cut_lineage(once, "toxicity-texts")
    tally = once.mapInArrow(words_of, "word string, label int").groupBy("word").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("good"),
    )
    tally = cut_lineage(tally, "word-tally")
    n = {r["label"]: r["count"] for r in once.groupBy("label").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    base, share = (bad + 1) / (bad + good + 2), F.col("bad") / (F.col("bad") + F.col("good"))
    # Likelihood of the labels of a word's documents, against that of the class's share.
    rest = F.when(F.col("good") > 0, F.col("good") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    gain = F.when(share > base, F.col("bad") * F.log(share / base) + rest).otherwise(0.0)
    marking = tally.withColumn("x", gain)
    size, most = marking.agg(F.count("*"), F.max("x")).first()
    # Chance alone reaches the logarithm of the number of words; of few documents no word may say that much.
    least = min(float(np.log(max(2, size))), LEAST_SHARE * (most or 0.0))
    marking = marking.where((F.col("x") > 0) & (F.col("x") >= least))
    toxic = [(r["word"], r["x"]) for r in marking.orderBy(F.desc("x"), "word").limit(WORDS_PER_CLASS).collect()]
    odds = F.log((F.col("bad") + 0.1) / (bad + 1)) - F.log((F.col("good") + 0.1) / (good + 1))
    clean = tally.where((F.col("good") > 0) & (odds < 1)).select("word", F.log1p("good").alias("x"))
    often = clean.orderBy(F.desc("x"), "word").limit(WORDS_PER_CLASS // 3)
    other = clean.orderBy(F.xxhash64("word"), "word").limit(2 * WORDS_PER_CLASS // 3)
    clean = {r["word"]: r["x"] for r in often.union(other).distinct().collect()}
    machine = StringMachine(*_fit_words(toxic, sorted(clean.items())), np.zeros(N_DOC), np.zeros(N_DOC), 0.0)
    for _ in range(ROUNDS if toxic else 0):
        toxic, hard = _witness_words(once, machine)
        if not toxic:
            break
        machine = machine._replace(**dict(zip(("table", "bias"), _fit_words(toxic, sorted((clean | hard).items())))))
    shared = df.sparkSession.sparkContext.broadcast(tuple(machine))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(StringMachine(*shared.value))
        for rows, _, _ in text_chunks(batches, "text"):
            x = scorer.features([t or "" for t in rows.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([rows.column("label"), pa.array([f.tobytes() for f in x], pa.binary())], ["label", "features"])

    seen = sample.select("text", "label").mapInArrow(features, "label int, features binary").collect()
    seen.sort(key=lambda r: (r["label"], bytes(r["features"])))
    x = np.array([np.frombuffer(r["features"]) for r in seen]).reshape(-1, N_DOC)
    return machine._replace(**dict(zip(("doc_mean", "doc_weights", "doc_bias"), _fit_documents(x, np.array([r["label"] for r in seen]), prior))))


def _witness_words(texts: DataFrame, machine: StringMachine) -> tuple[list[tuple[str, float]], dict[str, float]]:
    """Words of the toxic witnesses and of the worst clean sentences, at most ``WORDS_PER_CLASS`` each, by documents."""
    shared = texts.sparkSession.sparkContext.broadcast(tuple(machine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(StringMachine(*shared.value))
        for rows, _, _ in text_chunks(batches, "text"):
            found = scorer.witnesses([t or "" for t in rows.column("text").to_pylist()], rows.column("label").to_pylist())
            if found:
                word, label, margin = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(label, pa.int32()), pa.array(margin, pa.float64())], ["word", "label", "margin"])

    seen = texts.mapInArrow(run, "word string, label int, margin double")
    seen = seen.groupBy("label", "word").agg(F.count("*").cast("double").alias("n"), F.max("margin").alias("margin"))
    seen = cut_lineage(seen, "witnesses")
    toxic = seen.where("label = 1").orderBy(F.desc("n"), "word").limit(WORDS_PER_CLASS).collect()
    hard = seen.where("label = 0").orderBy(F.desc("margin"), "word").limit(WORDS_PER_CLASS).collect()
    return [(r["word"], r["n"]) for r in toxic], {r["word"]: r["n"] for r in hard}


def with_toxicity(df: DataFrame, machine: StringMachine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and rows, and the score of each whole text; a column of that name is replaced.

    A null text is scored like an empty one. No shuffle, one pass. The machine has a fixed size (1 MB).
    """
    shared = df.sparkSession.sparkContext.broadcast(tuple(machine))
    if score_col in df.columns:
        df = df.drop(score_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = StringMachine(*shared.value)
        scorer = Scorer(own)
        for rows, _, _ in text_chunks(batches, text_col):
            scores = own.scores(scorer.features([t or "" for t in rows.column(text_col).to_pylist()]))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(scores)], [*rows.schema.names, score_col])

    schema = df.select("*").withColumn(score_col, F.lit(0.0)).schema
    return df.mapInArrow(run, schema)


def op10_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; labels are learned only where the remainder by 3 is not 1."""
    picked = docs.select("doc_id", "text")
    machine = train_toxicity(picked, labels, bucket(3) != 1)
    return with_toxicity(picked, machine).select(
        "doc_id",
        F.coalesce(bucket(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
