"""Join queries: one result through every strategy, and the other join types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import join_broadcasting, join_copartitioned, matched, pair_totals, unmatched
from millrace.operators.layout import shuffle_width
from millrace.plans.registry import query
from millrace.session import scoped_session
from millrace.sources.tables import Tables

# -1 keeps Spark from broadcasting by size, both when it plans and when it re-plans.
NO_AUTO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}

_ORDERS_SQL = """
    SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment, o.o_totalprice
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""
_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "c_name", "c_mktsegment", "o_totalprice")


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    return (
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
        t.customer.select("c_custkey", "c_name", "c_mktsegment"),
    )


@query(_ORDERS_SQL)
def join_inner(t: Tables) -> DataFrame:
    orders, customers = t.orders, t.customer
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "inner").select(
        orders["o_orderkey"], orders["o_custkey"], customers["c_name"], customers["c_mktsegment"], orders["o_totalprice"]
    )


@query(_ORDERS_SQL)
def join_inner_sql(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment, o.o_totalprice"
        " FROM {orders} o INNER JOIN {customers} c ON o.o_custkey = c.c_custkey",
        orders=t.orders,
        customers=t.customer,
    )


@query(_ORDERS_SQL)
def join_broadcast_auto(t: Tables) -> DataFrame:
    orders, customers = _sides(t.on(scoped_session(t.spark, {"spark.sql.autoBroadcastJoinThreshold": "10485760"})))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(*_ORDER_COLUMNS)


@query(_ORDERS_SQL)
def join_sort_merge(t: Tables) -> DataFrame:
    orders, customers = _sides(t.on(scoped_session(t.spark, NO_AUTO_BROADCAST)))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(*_ORDER_COLUMNS)


@query(_ORDERS_SQL)
def join_broadcast_hint(t: Tables) -> DataFrame:
    orders, customers = _sides(t.on(scoped_session(t.spark, NO_AUTO_BROADCAST)))
    return join_broadcasting(orders, customers, F.col("o_custkey") == F.col("c_custkey")).select(*_ORDER_COLUMNS)


@query(_ORDERS_SQL)
def join_shuffle_hash(t: Tables) -> DataFrame:
    orders, customers = _sides(t)
    return orders.join(customers.hint("shuffle_hash"), F.col("o_custkey") == F.col("c_custkey")).select(
        *_ORDER_COLUMNS
    )


@query(_ORDERS_SQL)
def join_prepartitioned(t: Tables) -> DataFrame:
    orders, customers = _sides(t.on(scoped_session(t.spark, NO_AUTO_BROADCAST)))
    return join_copartitioned(orders, customers, "o_custkey", "c_custkey", shuffle_width(t.spark)).select(
        *_ORDER_COLUMNS
    )


def _documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source")


@query("""
    SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def join_left(t: Tables) -> DataFrame:
    documents, labels = _documents(t), t.labels
    return documents.join(labels, documents["doc_id"] == labels["doc_id"], "left").select(
        documents["doc_id"], "lang", "quality", "toxic"
    )


@query("""
    SELECT e.user_id, c.c_custkey, c.c_name
    FROM (SELECT DISTINCT user_id FROM events) e RIGHT JOIN customer c ON e.user_id = c.c_custkey
""")
def join_right(t: Tables) -> DataFrame:
    users, customers = t.events.select("user_id").distinct(), t.customer.select("c_custkey", "c_name")
    return users.join(customers, users["user_id"] == customers["c_custkey"], "right")


@query("""
    SELECT l.doc_id, l.quality, s.l_suppkey
    FROM labels l FULL JOIN (SELECT DISTINCT l_suppkey FROM lineitem) s ON l.doc_id = s.l_suppkey
""")
def join_full(t: Tables) -> DataFrame:
    """Two sets of numbers that overlap in part; either side has some that the other lacks."""
    labels, suppliers = t.labels.select("doc_id", "quality"), t.lineitem.select("l_suppkey").distinct()
    return labels.join(suppliers, labels["doc_id"] == suppliers["l_suppkey"], "outer")


_LABELLED_SQL = """
    SELECT doc_id, lang, source FROM documents d WHERE {test} (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""


@query(_LABELLED_SQL.format(test="EXISTS"))
def join_semi(t: Tables) -> DataFrame:
    return matched(_documents(t), t.labels, "doc_id", "doc_id")


@query(_LABELLED_SQL.format(test="NOT EXISTS"))
def join_anti(t: Tables) -> DataFrame:
    return unmatched(_documents(t), t.labels, "doc_id", "doc_id")


@query("""
    SELECT DISTINCT d.lang, d.source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    WHERE l.doc_id IS NULL
""")
def join_left_isnull(t: Tables) -> DataFrame:
    return unmatched(_documents(t), t.labels, "doc_id", "doc_id").select("lang", "source").distinct()


@query("""
    SELECT p.n_key AS join_key, p.n AS left_rows, s.n AS right_rows,
           CAST(CAST(p.n AS HUGEINT) * s.n AS DOUBLE) AS pairs
    FROM (SELECT l_partkey AS n_key, COUNT(*) AS n FROM lineitem GROUP BY l_partkey) p
    JOIN (SELECT l_suppkey AS n_key, COUNT(*) AS n FROM lineitem GROUP BY l_suppkey) s ON p.n_key = s.n_key
""")
def join_large_large(t: Tables) -> DataFrame:
    pairs = pair_totals(t.lineitem, t.lineitem, "l_partkey", "l_suppkey")
    return pairs.withColumn("pairs", F.col("pairs").cast("double"))
