"""The queries ``opN_<name>``: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    context_tree, decontamination, divergence, language_id, merkle, mixing, pivot_index, quality, quotations, run_length_index, signature_tree, style_tree,
    token_store,
)
from millrace.llm import sql
from millrace.llm.tools import fold
from millrace.session import scratch_path
from millrace.sources.tables import Tables


def op1_pivot_index(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_index.near_duplicates(Tables(spark, folder).embeddings)


def op2_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    found = style_tree.main_text(Tables(spark, folder).pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return decontamination.contaminated(t.documents, t.benchmark)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(Tables(spark, folder).documents)
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = Tables(spark, folder).documents
    held_out = fold("doc_id", 5, 0)
    model = language_id.fit(docs.filter(~held_out))
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_quotations(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.reply_ordered(Tables(spark, folder).conversations)


def op7_signature_tree(spark: SparkSession, folder: str) -> DataFrame:
    return signature_tree.near_duplicate_groups(Tables(spark, folder).documents)


def op8_token_store(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_tokens(Tables(spark, folder).documents, path)
    return token_store.digests(token_store.read_tokens(spark, path))


def op9_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold("doc_id", 10, 0)
    scored = context_tree.score_documents(Tables(spark, folder).documents, held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    held_out = fold("doc_id", 3, 1)
    scored = quality.scores(t.documents, t.labels.filter(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_run_length_index(spark: SparkSession, folder: str) -> DataFrame:
    return run_length_index.without_repeats(Tables(spark, folder).documents)


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(Tables(spark, folder).documents)


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.manifest(Tables(spark, folder).documents, fold("doc_id", 5, 0), lower)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_pivot_index, op2_style_tree, op3_decontamination, op4_mixing, op5_language_id, op6_quotations, op7_signature_tree,
        op8_token_store, op9_context_tree, op10_quality,
        op11_run_length_index, op12_divergence, op13_merkle,
    )
    return {query.__name__: query for query in named}


def oracle_sql() -> dict[str, str]:
    return {"op12_divergence": sql.DIVERGENCE, "op13_merkle": sql.MERKLE}
