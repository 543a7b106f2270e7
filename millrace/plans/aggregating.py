"""Aggregation, ordering and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import CENTS, exact_total, mean
from millrace.operators.aggregates import average_of, totals
from millrace.operators.sets import difference, intersection, union_distinct
from millrace.plans.registry import query
from millrace.plans.sqltext import exact_sum, half_up_mean, largest
from millrace.sources.tables import Tables


@query("SELECT COUNT(*) AS n_rows FROM lineitem")
def agg_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n_rows"))


@query("SELECT o_orderpriority, COUNT(*) AS n_orders FROM orders GROUP BY o_orderpriority")
def agg_group_count(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n_orders"))


@query("SELECT event_type, COUNT(*) AS count FROM events GROUP BY event_type")
def agg_group_count_short(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").count()


@query("SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n_orders FROM orders GROUP BY ALL")
def agg_group_multi(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n_orders"))


@query("SELECT COUNT(DISTINCT l_partkey) AS n_parts FROM lineitem")
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count_distinct("l_partkey").alias("n_parts"))


@query(f"SELECT l_suppkey, {exact_sum('l_extendedprice')} AS total FROM lineitem GROUP BY l_suppkey")
def agg_sum(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(exact_total(t.lineitem, "l_extendedprice", CENTS).cast("double").alias("total"))


@query("SELECT o_orderpriority, ROUND(AVG(o_totalprice), 2) AS avg_price FROM orders GROUP BY o_orderpriority")
def agg_avg_round(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 2).alias("avg_price"))


@query(f"SELECT event_type, {largest('value')} AS max_value FROM events GROUP BY event_type")
def agg_max_round(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.round(F.max("value"), 2).alias("max_value"))


@query("""
    SELECT l_returnflag, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship,
           MIN(l_quantity) AS min_quantity, MAX(l_quantity) AS max_quantity
    FROM lineitem GROUP BY l_returnflag
""")
def agg_min_max(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_quantity").alias("min_quantity"),
        F.max("l_quantity").alias("max_quantity"),
    )


@query(f"""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines, {half_up_mean('l_extendedprice')} AS avg_price,
           {largest('l_extendedprice')} AS max_price
    FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def agg_multi(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_lines"),
        mean(exact_total(t.lineitem, "l_extendedprice", CENTS), F.count("l_extendedprice")).cast("double").alias("avg_price"),
        F.round(F.max("l_extendedprice"), 2).alias("max_price"),
    )


@query(f"""
    SELECT o_custkey, COUNT(*) AS n_orders, {half_up_mean('o_totalprice')} AS avg_price
    FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
""")
def agg_filter_first(t: Tables) -> DataFrame:
    finished = t.orders.filter(F.col("o_orderstatus") == "F")
    return totals(finished, "o_custkey", "o_totalprice", scale=CENTS).select(
        "o_custkey", F.col("n_rows").alias("n_orders"), average_of().cast("double").alias("avg_price")
    )


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def agg_distinct(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query("SELECT DISTINCT text, lang FROM documents")
def agg_drop_duplicates(t: Tables) -> DataFrame:
    return t.documents.select("text", "lang").dropDuplicates()


@query("SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey ORDER BY n_orders DESC, o_custkey")
def ord_desc(t: Tables) -> DataFrame:
    return (
        t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders")).orderBy(F.desc("n_orders"), "o_custkey")
    )


@query("SELECT p_name, p_partkey, p_retailprice FROM part ORDER BY p_name, p_partkey")
def ord_asc(t: Tables) -> DataFrame:
    return t.part.select("p_name", "p_partkey", "p_retailprice").orderBy("p_name", "p_partkey")


@query("""
    SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey
""")
def ord_multi(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderpriority", "o_totalprice", "o_orderkey")
    return orders.orderBy(F.asc("o_orderpriority"), F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("SELECT LEAST(25, COUNT(*)) AS n_rows, LEAST(25, COUNT(*)) AS n_known FROM orders")
def ord_limit(t: Tables) -> DataFrame:
    """Some rows, whichever come first: how many, and how many of them are rows of the table.

    The rows are fetched, as the first 25 are not the same ones each time they are computed; the
    table is probed for them where it lies, nothing of it is shuffled.
    """
    orders = t.orders.select("o_orderkey", "o_orderdate")
    some = t.spark.createDataFrame(orders.limit(25).collect(), orders.schema)  # 25 rows at most
    known = orders.join(F.broadcast(some), ["o_orderkey", "o_orderdate"], "left_semi").distinct().withColumn("known", F.lit(True))
    return some.withColumn("taken", F.lit(True)).join(F.broadcast(known), ["o_orderkey", "o_orderdate"], "left").agg(
        F.count("taken").alias("n_rows"), F.count("known").alias("n_known")
    )


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25")
def ord_first(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey").limit(25)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def ord_topk(t: Tables) -> DataFrame:
    return (
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(15)
    )


def customer_keys(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("person"))


def event_users(t: Tables) -> DataFrame:
    """One row per event; not every customer has one."""
    return t.events.select(F.col("user_id").alias("person"))


_CUSTOMERS_SQL = "SELECT c_custkey AS person FROM customer"
_USERS_SQL = "SELECT user_id AS person FROM events"


@query(f"{_CUSTOMERS_SQL} UNION {_USERS_SQL}")
def set_union(t: Tables) -> DataFrame:
    return union_distinct(customer_keys(t), event_users(t)).orderBy("person")


@query(f"""
    SELECT person, 'customer' AS source FROM ({_CUSTOMERS_SQL})
    UNION ALL SELECT person, 'event' AS source FROM ({_USERS_SQL})
""")
def set_union_all_tagged(t: Tables) -> DataFrame:
    return customer_keys(t).withColumn("source", F.lit("customer")).unionAll(
        event_users(t).withColumn("source", F.lit("event"))
    )


@query(f"{_CUSTOMERS_SQL} INTERSECT {_USERS_SQL}")
def set_intersect(t: Tables) -> DataFrame:
    return intersection(customer_keys(t), event_users(t))


@query(f"{_CUSTOMERS_SQL} EXCEPT {_USERS_SQL}")
def set_except(t: Tables) -> DataFrame:
    return difference(customer_keys(t), event_users(t))


@query("SELECT doc_id FROM documents WHERE lang = 'en' EXCEPT SELECT doc_id FROM labels")
def job_compliance(t: Tables) -> DataFrame:
    """Documents of one language, which should all be labelled, that are not."""
    return difference(t.documents.filter(F.col("lang") == "en").select("doc_id"), t.labels.select("doc_id"))
