"""Filter queries; every predicate but the null tests reaches the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.sources.tables import Tables


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def flt_eq(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def flt_neq(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderstatus")


@query("SELECT event_id, event_type, value FROM events WHERE value > 100")
def flt_gt(t: Tables) -> DataFrame:
    return t.events.filter(F.col("value") > 100).select("event_id", "event_type", "value")


@query("SELECT p_partkey, p_size FROM part WHERE p_size >= 10 AND p_size <= 20")
def flt_range(t: Tables) -> DataFrame:
    return t.part.filter((F.col("p_size") >= 10) & (F.col("p_size") <= 20)).select("p_partkey", "p_size")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_totalprice > 100000
""")
def flt_and(t: Tables) -> DataFrame:
    return (
        t.orders.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
        .filter(F.col("o_totalprice") > 100000)
        .select("o_orderkey", "o_totalprice")
    )


@query("SELECT p_partkey, p_type, p_size FROM part WHERE p_type = 'PROMO' OR p_size < 5")
def flt_or(t: Tables) -> DataFrame:
    return t.part.filter((F.col("p_type") == "PROMO") | (F.col("p_size") < 5)).select("p_partkey", "p_type", "p_size")


@query("SELECT p_partkey, p_type FROM part WHERE p_type IN ('SMALL', 'MEDIUM', 'LARGE')")
def flt_in(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_type").isin("SMALL", "MEDIUM", "LARGE")).select("p_partkey", "p_type")


@query("SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'blue')")
def flt_startswith(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name").startswith("blue")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'S%'")
def flt_like(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_type").like("S%")).select("p_partkey", "p_type")


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def flt_contains(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name").contains("ring")).select("p_partkey", "p_name")


def labelled_documents(t: Tables) -> DataFrame:
    """Every document with its quality label, null where it has none."""
    documents = t.documents.select("doc_id", "lang")
    return documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")


@query("SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL")
def flt_isnull(t: Tables) -> DataFrame:
    return labelled_documents(t).filter(F.col("quality").isNull()).select("doc_id", "lang")


@query("""
    SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL
""")
def flt_isnotnull(t: Tables) -> DataFrame:
    return labelled_documents(t).filter(F.col("quality").isNotNull())
