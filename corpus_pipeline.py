"""The corpus pipeline: each stage works on all rows that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayengine.llm import bpe, decontaminate, language, lines, near_dups
from delayengine.llm.queries import VOCABULARY, reach
from delayengine.session import stage


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from them; the others go."""
    reach(spark)
    return language.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later lines go from the texts, and documents of which nothing is left."""
    reach(spark)
    return lines.remove_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    reach(spark)
    return near_dups.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    reach(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids, their number, and digests of the ids and of the text decoded from them."""
    reach(spark)
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    coded = bpe.round_trip(docs.select("doc_id", "text"), path, pattern)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), *bpe.digest_columns())


STAGES = [
    ("language_id", identify),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", dedup_documents),
    ("decontamination", drop_benchmark),
    ("byte_bpe", tokenize),
]

# Greedy line removal, MinHash components and byte-pair merges have no SQL form: tests/llm runs the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
