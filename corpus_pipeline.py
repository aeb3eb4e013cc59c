"""Corpus cleaning from documents to packed sequences, as a list of stages.

Every stage but the last takes and returns rows with the columns of ``documents``; the next one works
on all that it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.llm.ngram_join import ngram_join
from streamlab.llm.packing import pack_documents
from streamlab.llm.quality import CUT, bucket, train_quality, with_quality
from streamlab.llm.queries import vocabulary_path
from streamlab.llm.substrings import remove_repeats
from streamlab.llm.toxicity import train_toxicity, with_toxicity
from streamlab.plans.lineage import cut_lineage


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _free_name(docs: DataFrame) -> str:
    """A column name that the documents do not have."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier passes. Labels of one id in four stay unseen, as in its own query.

    A null text is empty and scored as such; rows that repeat an id are scored one by one. All columns stay.
    """
    model = train_quality(docs, _labels(spark, sf_dir), bucket(4) != 2)
    score = _free_name(docs)
    return with_quality(docs, model, score_col=score).where(F.col(score) >= CUT).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic. Labels of one id in three stay unseen, as in its own query.

    A null text is empty and not toxic; rows that repeat an id are scored one by one. All columns stay.
    """
    machine = train_toxicity(docs, _labels(spark, sf_dir), bucket(3) != 1)
    score = _free_name(docs)
    return with_toxicity(docs, machine, score_col=score).where(F.col(score) < CUT).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; documents without a partner stay.

    Rows without an id stay, as they cannot be told apart. Of rows that repeat an id, all stay or none.
    """
    gone = ngram_join(docs).where("doc_id <> class_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that occur earlier; ``n_chars`` is counted anew. No row goes."""
    found = remove_repeats(docs)
    columns = {c: F.col(f"other.{c}") for c in docs.columns if c != "text"}
    columns |= {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full sequences. A null text is empty: its piece is the end mark alone."""
    return pack_documents(docs, vocabulary_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: Learned scores and tokenizers are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
