"""The training-data pipeline: documents in, token ids in ORC files out.

Each stage works on the rows that the one before it kept, reread from Parquet in the shared
scratch folder. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, language_id, mixing, signature_tree, token_store
from millrace.llm.tools import stored
from millrace.session import scratch_path
from millrace.sources.tables import Tables


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; learned from the labelled ones among them."""
    return language_id.identified(docs, language_id.fit(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return signature_tree.one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.without_contaminated(docs, Tables(spark, sf_dir).benchmark)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.repeated(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC files; where each document starts, its length and checksum, read back from them."""
    folder = scratch_path(spark, "tokens")
    token_store.write_tokens(docs, folder)
    return token_store.digests(token_store.read_tokens(spark, folder))


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_store", token_stage),
]

#: Language identification and token ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
