"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from delayengine.llm import (
    bpe, decontaminate, language, lines, merkle, near_dups, ngram_lm, oracles, packing, pages, phrases, secrets, toxicity,
    whitening,
)

BATCH_BYTES = 8 << 20
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def reach(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from where the driver has it, and bound their batches.

    On a cluster the package must be shipped (``--py-files``) or installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_corpus(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.clean_lines(_table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_corpus(_table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_corpus(_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.linked_documents(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_corpus(_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.texts(_table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_corpus(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_table(_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_line_dedup, op3_lm_scoring, op4_byte_bpe, op5_fingerprints, op6_ngram_jaccard,
        op7_language_id, op8_html_extraction, op9_decontamination, op10_secret_scans, op11_whitening, op12_collocations,
        op13_packing,
    )
}

# The other results can't be expressed in SQL as a whole: tests/llm holds them against brute force.
ORACLES: dict[str, str] = {"op12_collocations": oracles.COLLOCATIONS}
