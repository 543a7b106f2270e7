"""Projection, expression and function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import proper_name, report_line
from millrace.functions.udfs import proper_name_udf, register_proper_name
from millrace.functions.values import value_tier
from millrace.plans.registry import query
from millrace.session import scoped_session
from millrace.sources.tables import Tables

# Limits that give the tiers of whole orders three well-filled classes.
ORDER_HIGH, ORDER_MEDIUM = 400000, 100000


@query("SELECT p_partkey AS id, p_name AS label, p_brand AS brand FROM part")
def prj_todf(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name", "p_brand").toDF("id", "label", "brand")


@query("SELECT p_brand, p_type FROM part")
def prj_select(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type")


@query("SELECT p_partkey AS id, p_brand, p_name AS part_name, p_type AS kind FROM part")
def prj_alias(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"), "p_brand", F.col("p_name").alias("part_name"), F.col("p_type").alias("kind")
    )


@query("SELECT * FROM part")
def prj_star(t: Tables) -> DataFrame:
    return t.part.alias("p").select("p.*")


@query("""
    SELECT o_orderkey, o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS finished,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'U'
                WHEN o_orderpriority = '2-HIGH' THEN 'H'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'M' ELSE 'OT' END AS priority_code
    FROM orders
""")
def prj_with_column(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    return (
        t.orders.withColumn("finished", F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No"))
        .withColumn(
            "priority_code",
            F.when(priority == "1-URGENT", "U")
            .when(priority == "2-HIGH", "H")
            .when(priority == "3-MEDIUM", "M")
            .otherwise("OT"),
        )
        .select("o_orderkey", "o_totalprice", "finished", "priority_code")
    )


@query("SELECT r_regionkey AS id, r_name AS kind FROM region")
def prj_rename(t: Tables) -> DataFrame:
    return t.region.withColumnRenamed("r_regionkey", "id").withColumnRenamed("r_name", "kind")


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def prj_drop(t: Tables) -> DataFrame:
    return t.customer.drop("c_acctbal")


@query("SELECT s_name AS entity_name, s_nationkey AS base_type FROM supplier")
def prj_quoted_names(t: Tables) -> DataFrame:
    bases = t.supplier.toDF("License Number", "Entity Name", "Type of Base", "Balance")
    return t.spark.sql(
        "SELECT `Entity Name` AS entity_name, `Type of Base` AS base_type FROM {bases}", bases=bases
    )


@query("SELECT p_type, COUNT(*) AS n FROM part WHERE p_brand = 'Brand#7' GROUP BY p_type")
def src_temp_view(t: Tables) -> DataFrame:
    # A session of its own keeps the caller's view names free.
    spark = scoped_session(t.spark, {})
    t.on(spark).register_views("part")
    return spark.sql(
        "SELECT p_type, COUNT(*) AS n FROM part WHERE p_brand = 'Brand#7' GROUP BY p_type ORDER BY n DESC"
    )


@query("""
    SELECT p_name, p_type, CASE WHEN p_type = 'PROMO' THEN 'PR' ELSE 'OT' END AS type_code
    FROM part WHERE p_brand = 'Brand#7'
""")
def sql_then_df(t: Tables) -> DataFrame:
    coded = (
        t.spark.sql("SELECT * FROM {part} WHERE p_brand = 'Brand#7'", part=t.part)
        .withColumn("type_code", F.when(F.col("p_type") == "PROMO", "PR").otherwise("OT"))
    )
    # The key tells parts of one name apart, so they can be divided among tasks.
    return coded.orderBy("p_name", "p_partkey").select("p_name", "p_type", "type_code")


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'Credit' ELSE 'Debt' END AS balance_kind FROM customer")
def scl_case_two(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, "Credit").otherwise("Debt").alias("balance_kind")
    )


@query(f"""
    SELECT o_orderkey,
           CASE WHEN o_totalprice >= {ORDER_HIGH} THEN 'High'
                WHEN o_totalprice >= {ORDER_MEDIUM} THEN 'Medium' ELSE 'Low' END AS value_tier
    FROM orders
""")
def scl_case_multi(t: Tables) -> DataFrame:
    tier = value_tier("o_totalprice", ORDER_HIGH, ORDER_MEDIUM)
    return t.orders.select("o_orderkey", tier.alias("value_tier"))


@query("SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name FROM customer")
def scl_concat(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.concat("c_name", F.lit(" "), "c_mktsegment").alias("full_name"))


@query("SELECT p_partkey, printf('Part: %-35s | Type: %s', p_name, p_type) AS line FROM part")
def scl_format(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", report_line("Part", "p_name", "Type", "p_type").alias("line"))


@query("""
    SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type,
           p_brand || '/' || p_type AS joined, replace(p_name, ' ', '_') AS snake_name
    FROM part
""")
def scl_strings(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.upper("p_name").alias("upper_name"),
        F.lower("p_type").alias("lower_type"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.regexp_replace("p_name", " ", "_").alias("snake_name"),
    )


def comma_names(t: Tables) -> DataFrame:
    """Part names in the form ``FIRST,SECOND``."""
    return t.part.select("p_partkey", F.upper(F.regexp_replace("p_name", " ", ",")).alias("name"))


_NAMES_SQL = """
    SELECT p_partkey, upper(replace(p_name, ' ', ',')) AS name,
           upper(p_name[1]) || lower(split_part(p_name, ' ', 1)[2:]) || ', '
           || upper(split_part(p_name, ' ', 2)[1]) || lower(split_part(p_name, ' ', 2)[2:]) AS formatted_name
    FROM part
"""


@query(_NAMES_SQL)
def udf_name_case(t: Tables) -> DataFrame:
    return comma_names(t).select("p_partkey", "name", proper_name("name").alias("formatted_name"))


@query(_NAMES_SQL)
def udf_sql(t: Tables) -> DataFrame:
    # The function is registered in a sibling session; the caller's stays as it is.
    spark = scoped_session(t.spark, {})
    function = register_proper_name(spark)
    return spark.sql(
        f"SELECT p_partkey, name, {function}(name) AS formatted_name FROM {{names}}", names=comma_names(t.on(spark))
    )


@query(_NAMES_SQL)
def udf_call(t: Tables) -> DataFrame:
    spark = scoped_session(t.spark, {})
    function = register_proper_name(spark)
    return comma_names(t.on(spark)).select("p_partkey", "name", F.call_udf(function, "name").alias("formatted_name"))


@query(_NAMES_SQL)
def udf_object(t: Tables) -> DataFrame:
    return comma_names(t).select("p_partkey", "name", proper_name_udf()("name").alias("formatted_name"))
