"""Joins, sets and actions on small inputs with nulls and duplicates."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregates import distinct_totals
from millrace.operators.joins import matched, unmatched
from millrace.operators.sets import difference, intersection, union_distinct


@pytest.fixture
def left(spark):
    return spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "c"), (3, "d")], "k INT, v STRING")


@pytest.fixture
def right(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (2, None), (None, "c"), (9, "z")], "k INT, v STRING")


def test_sets_agree_with_sql(spark, left, right, rows):
    for operator, word in ((union_distinct, "UNION"), (intersection, "INTERSECT"), (difference, "EXCEPT")):
        expected = spark.sql(f"SELECT * FROM {{l}} {word} SELECT * FROM {{r}}", l=left, r=right)
        assert rows(operator(left, right)) == rows(expected)
        assert operator(left, right).columns == ["k", "v"]


def test_null_equals_null_in_sets(left, right, rows):
    assert (None, "c") in rows(intersection(left, right))
    assert rows(difference(left, right)) == [(3, "d")]


def test_matched_rows_appear_once_per_left_row(left, right, rows):
    assert rows(matched(left, right, "k", "k")) == rows(left.filter("k IN (1, 2)"))


def test_a_null_key_never_matches(left, right, rows):
    assert rows(unmatched(left, right, "k", "k")) == [(3, "d"), (None, "c")]


def test_anti_join_agrees_with_left_join_and_null_test(spark, left, right, rows):
    by_sql = spark.sql(
        "SELECT DISTINCT l.* FROM {l} l LEFT JOIN {r} r ON r.k = l.k WHERE r.k IS NULL", l=left, r=right
    )
    assert rows(unmatched(left, right, "k", "k").distinct()) == rows(by_sql)


def test_totals_leave_out_duplicate_rows(spark, rows):
    df = spark.createDataFrame([(1, 2.5), (1, 2.5), (1, 1.0), (2, None)], "k INT, v DOUBLE")
    found = [(row.k, None if row.total is None else str(row.total)) for row in distinct_totals(df, "k", "v", 2).collect()]
    assert sorted(found) == [(1, "3.50"), (2, None)]


def test_actions(spark, tables, tmp_path, capsys):
    part = tables.part.orderBy("p_partkey")
    assert part.first().p_partkey == 0
    assert [row.p_partkey for row in part.take(3)] == [0, 1, 2]
    assert len(part.collect()) == part.count()
    part.show(2, truncate=False)
    part.printSchema()
    shown = capsys.readouterr().out
    assert "p_name" in shown and "|-- p_size: integer" in shown


def test_rdd_form_of_the_line_flow_agrees(spark, tables, tmp_path, folder):
    """The same flow on an RDD, which runs its functions in Python."""
    import __spark_entry__ as entry_module

    path = str(tmp_path / "parts")
    tables.part.write.csv(path, header=True)
    lines = (
        spark.sparkContext.textFile(path)
        .map(lambda line: line.split(","))
        .filter(lambda field: field[0] != "p_partkey")
        .filter(lambda field: field[3] == "PROMO")
        .filter(lambda field: int(field[4]) >= 25)
        .map(lambda field: f"Part: {field[1]:<35} | Type: {field[3]}")
    )
    by_frame = [row.line for row in entry_module.queries()["rdd_lines"](spark, folder).collect()]
    assert sorted(lines.collect()) == sorted(by_frame)
    numbers = spark.sparkContext.parallelize([1, 2, 3, 4, 5])
    assert numbers.collect() == [row.value for row in spark.createDataFrame([(i,) for i in range(1, 6)], "value INT").collect()]


def test_sql_and_dataframe_reports_agree(spark, folder, rows):
    import __spark_entry__ as entry_module

    queries = entry_module.queries()
    for one, other in (
        ("job_zone_mix_df", "job_zone_mix_sql"), ("join_inner", "join_inner_sql"),
        ("nst_explode", "nst_explode_sql"), ("udf_name_case", "udf_sql"),
    ):
        assert rows(queries[one](spark, folder)) == rows(queries[other](spark, folder))


def test_physical_partition_number(spark):
    numbers = spark.range(0, 8, numPartitions=4).select(F.spark_partition_id().alias("p"))
    assert sorted(row.p for row in numbers.collect()) == [0, 0, 1, 1, 2, 2, 3, 3]
