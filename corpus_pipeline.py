"""A training-data pipeline over ``documents``: what to keep, cleaned, and its tokens.

Each stage is a function of the session, the documents kept so far and the folder of
the tables, and returns the documents it keeps; the last one returns their tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagshelf.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from tagshelf.sources.scratch import materialize

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned on this corpus' labels, does not reject."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, cut down to the lines they keep; ``n_chars`` is that of what is left."""
    kept = line_dedup.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.one_of_each(docs, words=4, distance=4)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How each document is encoded, and what that decodes to."""
    ranks = bpe.read_ranks(spark, public_tokenizers.path(RANK_FILE))
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_near_copies),
    ("benchmark decontamination", without_test_items),
    ("byte-level BPE", tokens),
]

# Neither fingerprints nor merges can be said in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written, and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
