"""The registered queries of this subpackage and, where SQL can say the same, their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamlab.llm.filter_audit import ORACLE as AUDIT_ORACLE
from streamlab.llm.filter_audit import op13_audit
from streamlab.llm.fingerprints import op6_fingerprints
from streamlab.llm.hard_negatives import ORACLE as NEGATIVES_ORACLE
from streamlab.llm.hard_negatives import op11_negatives
from streamlab.llm.html_text import op2_html
from streamlab.llm.licenses import op1_licenses
from streamlab.llm.multi_index import op7_neighbours
from streamlab.llm.ngram_join import ORACLE as NGRAM_ORACLE
from streamlab.llm.ngram_join import op9_join
from streamlab.llm.packing import op5_pack
from streamlab.llm.quality import op8_quality
from streamlab.llm.substrings import ORACLE as REPEATS_ORACLE
from streamlab.llm.substrings import op4_repeats
from streamlab.llm.token_counts import op12_counts
from streamlab.llm.toxicity import op10_toxicity
from streamlab.llm.word_bpe import op3_bpe

VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_licenses(_read(spark, sf_dir, "documents"))


def op2_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_html(_read(spark, sf_dir, "pages"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_bpe(_read(spark, sf_dir, "documents"), vocabulary_path())


def op4_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_repeats(_read(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_pack(_read(spark, sf_dir, "documents"), vocabulary_path())


def op6_one_permutation_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_fingerprints(_read(spark, sf_dir, "documents"))


def op7_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_neighbours(_read(spark, sf_dir, "embeddings"))


def op8_quality_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_join(_read(spark, sf_dir, "documents"))


def op10_toxicity_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_negatives(_read(spark, sf_dir, "embeddings"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_counts(_read(spark, sf_dir, "documents"), vocabulary_path(BYTE_VOCABULARY))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_license_scan, op2_html_density, op3_bpe_round_trip, op4_repeated_substrings, op5_packing,
        op6_one_permutation_fingerprints, op7_inverted_multi_index, op8_quality_bradley_terry, op9_ngram_join,
        op10_toxicity_string_kernel, op11_hard_negatives, op12_token_counts, op13_filter_audit,
    )
    return {fn.__name__: fn for fn in own}


def llm_oracles() -> dict[str, str]:
    return {
        "op4_repeated_substrings": REPEATS_ORACLE,
        "op9_ngram_join": NGRAM_ORACLE,
        "op11_hard_negatives": NEGATIVES_ORACLE,
        "op13_filter_audit": AUDIT_ORACLE,
    }
