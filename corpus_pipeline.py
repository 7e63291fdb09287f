"""The corpus pipeline: toxic documents, exact copies, near copies and benchmark leaks go, the rest is encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns
of ``documents``, whatever their names and number. A null text is an empty text throughout, and an empty table
passes through. Texts are taken whole, whatever their length. Of copies and near copies the smallest id stays; rows
that repeat id and text are one document and stay or go together. Rows without an id are judged like others, and stay only
where no copy has an id. Null labels and passages teach and match nothing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from abacist.llm import byte_bpe, decontaminate, exact_dedup, simhash, toxicity
from abacist.llm.common import store
from abacist.sources.tables import read_table

# Neighbour votes, alignments and byte-level merges have no SQL form.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, width=3, distance=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on what the one before has written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
