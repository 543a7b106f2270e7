"""The comparison with SQL ignores order; these tests look at it."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module

ORDERS = {
    "ord_asc": lambda r: (r["p_name"], r["p_partkey"]),
    "ord_desc": lambda r: (-r["n_orders"], r["o_custkey"]),
    "ord_multi": lambda r: (r["o_orderpriority"], -r["o_totalprice"], r["o_orderkey"]),
    "ord_topk": lambda r: (-r["o_totalprice"], r["o_orderkey"]),
    "ord_first": lambda r: (r["o_orderdate"], r["o_orderkey"]),
    "set_union": lambda r: r["person"],
    "fire_q3": lambda r: (-r["n"], r["event_type"]),
    "fire_q9": lambda r: (r["user_id"], -r["n"], r["event_type"]),
    "fire_q10": lambda r: (-r["avg_value"], r["user_id"]),
    "job_zone_mix_df": lambda r: (r["p_brand"], -r["n"], r["p_type"]),
    "job_order_detail": lambda r: (r["order_date"], r["order_id"]),
    "job_sales_summary": lambda r: (-r["total_revenue"], r["category"]),
    "job_customer_report": lambda r: (-r["total_spend"], r["customer_id"]),
    "nst_group_nested": lambda r: (-r["count"], r["city"]),
}


@pytest.mark.parametrize("name", ORDERS)
def test_rows_arrive_in_order(spark, folder, name):
    keys = [ORDERS[name](row) for row in entry_module.queries()[name](spark, folder).collect()]
    assert keys == sorted(keys)
    assert len(keys) > 1


def test_nulls_first_ascending_and_last_descending(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "v INT")
    assert [r.v for r in df.orderBy("v").collect()] == [None, 1, 2]
    assert [r.v for r in df.orderBy(F.desc("v")).collect()] == [2, 1, None]


def test_plain_limit_gives_some_rows_of_the_table(tables, rows):
    some = rows(tables.part.select("p_partkey").limit(7))
    assert len(some) == 7
    assert set(some) <= set(rows(tables.part.select("p_partkey")))
