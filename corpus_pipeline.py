"""The corpus pipeline: from raw documents to token files.

Every stage takes what its predecessor kept, as Parquet, and its decisions take effect: toxic documents go, then all but one of
each class of near duplicates, then documents that hold benchmark items; the rest is mixed to the sources' target weights,
which repeats documents of scarce sources and leaves out some of plentiful ones, and written as token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelsift.llm import decontamination, mixing, near_duplicates, token_files, toxicity
from reelsift.llm.common import table, vocabulary
from reelsift.session import durable


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each_class(docs)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_files(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", keep_civil),
    ("ngram_jaccard", keep_one_of_each),
    ("decontamination", keep_clean_of_benchmark),
    ("mixing", mix_to_weights),
    ("token_files", write_tokens),
]

#: SQL can neither fit the trees nor encode tokens; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the mix, read back from the token files."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
