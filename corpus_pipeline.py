"""The corpus pipeline: stages over ``documents``, each on what the one before it kept.

Every stage but the last returns the columns of its input.  Rows that a stage
does not reject pass it unchanged, but for the text where the stage edits it.
Each operator's own cases (nulls, empty texts, repeated rows, empty tables,
extra columns) hold here too.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventide.llm import decontaminate, dropout, linededup, similarity, toxicity
from eventide.llm.common import materialize, ship, small_batches
from eventide.llm.queries import table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored toxic go."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that recur across documents; every document stays."""
    ship(spark)
    small_batches(spark)
    return linededup.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship(spark)
    small_batches(spark)
    return similarity.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def subword_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (merge dropout), decoded_sha256 of what they decode to."""
    ship(spark)
    small_batches(spark)
    return dropout.encoded_report(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("subword_encoding", subword_encoding),
]

#: the classifier and the encoder have no SQL form; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
