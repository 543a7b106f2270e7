"""The physical plans the operators are written for."""

import pytest
from pyspark.sql import functions as F

from millrace.plans import catalog
from millrace.operators.joins import join_broadcasting
from millrace.plans.joining import NO_AUTO_BROADCAST
from millrace.plans.nested import employee_rows, json_arrays
from millrace.session import scoped_session
from millrace.sources.tables import Tables

QUERIES = catalog.queries()

STRATEGIES = {
    "join_broadcast_auto": "BroadcastHashJoin",
    "join_broadcast_hint": "BroadcastHashJoin",
    "join_sort_merge": "SortMergeJoin",
    "join_shuffle_hash": "ShuffledHashJoin",
    "join_prepartitioned": "SortMergeJoin",
}


@pytest.mark.parametrize("name", STRATEGIES)
def test_join_strategy(spark, folder, plan, name):
    assert STRATEGIES[name] in plan(QUERIES[name](spark, folder))


def test_join_hints(spark, folder, plan):
    scoped = scoped_session(spark, NO_AUTO_BROADCAST)
    t = Tables(scoped, folder)
    by_sql = scoped.sql(
        "SELECT /*+ BROADCAST(c) */ o.o_orderkey FROM {o} o JOIN {c} c ON o.o_custkey = c.c_custkey",
        o=t.orders, c=t.customer,
    )
    assert "BroadcastHashJoin" in plan(by_sql)
    plain = Tables(spark, folder)
    merged = plain.orders.hint("merge").join(plain.customer, F.col("o_custkey") == F.col("c_custkey"))
    assert "SortMergeJoin" in plan(merged)


def test_large_side_is_not_broadcast(spark, folder, plan):
    t = Tables(scoped_session(spark, NO_AUTO_BROADCAST), folder)
    joined = join_broadcasting(t.orders, t.customer, F.col("o_custkey") == F.col("c_custkey"), limit=100)
    assert "SortMergeJoin" in plan(joined)


def test_prepartitioned_join_adds_no_shuffle(spark, folder, plan):
    assert plan(QUERIES["join_prepartitioned"](spark, folder)).count("Exchange") == 2


def test_group_count_is_partial_then_final(spark, folder, plan):
    text = plan(QUERIES["agg_group_count"](spark, folder))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


@pytest.mark.parametrize("name", ["set_intersect", "set_except", "job_compliance"])
def test_set_operations_shuffle_once(spark, folder, plan, name):
    text = plan(QUERIES[name](spark, folder))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_union_all_does_not_shuffle(spark, folder, plan):
    assert "Exchange" not in plan(QUERIES["set_union_all_tagged"](spark, folder))


def test_anti_join_sees_each_key_once(spark, folder, plan):
    text = plan(QUERIES["join_anti"](spark, folder))
    assert "LeftAnti" in text and "HashAggregate" in text


@pytest.mark.parametrize("name", ["ord_topk", "ord_first", "fire_q2", "fire_q5", "fire_q6", "fire_q8"])
def test_topk_needs_no_range_shuffle(spark, folder, plan, name):
    text = plan(QUERIES[name](spark, folder))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["flt_eq", "flt_neq", "flt_gt", "flt_range", "flt_and", "flt_or", "flt_in",
                                  "flt_startswith", "flt_like", "flt_contains"])
def test_filters_reach_the_scan(spark, folder, plan, name):
    text = plan(QUERIES[name](spark, folder))
    assert "PushedFilters: []" not in text


def test_scan_reads_only_used_columns(spark, folder, plan):
    text = plan(QUERIES["agg_sum"](spark, folder))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in text


def test_reports_sum_before_joining(spark, folder, plan):
    for name in ("job_sales_summary", "job_customer_report"):
        text = plan(QUERIES[name](scoped_session(spark, NO_AUTO_BROADCAST), folder))
        below_join = text[text.index("SortMergeJoin"):]
        assert below_join.count("HashAggregate") == 2


def test_python_appears_only_in_udf_queries(spark, folder, plan):
    for name in ("udf_sql", "udf_call", "udf_object"):
        assert "ArrowEvalPython" in plan(QUERIES[name](spark, folder))
    assert "Python" not in plan(QUERIES["udf_name_case"](spark, folder))


def test_line_flow_is_one_stage(spark, folder, plan):
    assert "Exchange" not in plan(QUERIES["rdd_lines"](spark, folder))


@pytest.mark.parametrize("name", QUERIES)
def test_no_plan_forms_all_pairs_or_leaves_the_jvm(spark, folder, plan, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if not name.startswith("udf_"):
        assert "Python" not in text and "InPandas" not in text


def test_documents_are_written_by_the_jvm(spark, folder, plan):
    text = plan(json_arrays(employee_rows(Tables(spark, folder))))
    assert "Python" not in text and "InPandas" not in text


@pytest.mark.parametrize("name", ["ord_asc", "ord_multi", "job_order_detail"])
def test_a_filter_after_sorting_reaches_the_scan(spark, folder, plan, name):
    column = {"ord_asc": "p_name", "ord_multi": "o_orderpriority", "job_order_detail": "status"}[name]
    text = plan(QUERIES[name](spark, folder).filter(F.col(column) == "F").select(column))
    assert "EqualTo(" in text


def test_rows_of_a_limit_are_looked_up_without_a_shuffle_of_the_table(tables, plan):
    from millrace.plans.aggregating import ord_limit

    text = plan(ord_limit(tables))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "SortMergeJoin" not in text
