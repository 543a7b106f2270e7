import os
import subprocess
import sys

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.serializers import CloudPickleSerializer

from millrace.functions.text import proper_name, report_line
from millrace.functions.udfs import proper_name_udf, register_proper_name
from millrace.operators.aggregates import totals
from millrace.functions.values import exact_total, mean, response_speed, value_tier

NAMES = {
    "CHAN,MEI": "Chan, Mei",
    "SMITH, JOHN": "Smith,  john",
    "SOLO": "Solo",
    "A,": "A",
    "A,,": "A",
    "A,,B": "A, , B",
    "": "",
    ",": "",
    "éclair,über": "Éclair, Über",
    " PAD,END ": "pad, End ",
    None: None,
}


def test_proper_name(spark):
    df = spark.createDataFrame([(name,) for name in NAMES], "name STRING")
    found = {row.name: row.cased for row in df.select("name", proper_name("name").alias("cased")).collect()}
    assert found == NAMES


def test_function_object_named_function_and_expression_agree(spark):
    df = spark.createDataFrame([(name,) for name in NAMES], "name STRING")
    function = register_proper_name(spark)
    forms = df.select(
        proper_name("name").alias("a"), proper_name_udf()("name").alias("b"), F.call_udf(function, "name").alias("c")
    )
    for row in forms.collect():
        assert row.a == row.b == row.c
    by_sql = spark.sql(f"SELECT name, {function}(name) AS cased FROM {{df}}", df=df)
    assert {row.name: row.cased for row in by_sql.collect()} == NAMES


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abCD ,é-", max_size=12), min_size=1, max_size=30))
def test_expression_and_function_agree_on_any_text(spark, names):
    df = spark.createDataFrame([(name,) for name in names], "name STRING")
    both = df.select(proper_name("name").alias("a"), proper_name_udf()("name").alias("b"))
    assert all(row.a == row.b for row in both.collect())


def test_function_needs_no_package_on_the_executor(tmp_path):
    shipped = tmp_path / "function.bin"
    shipped.write_bytes(CloudPickleSerializer().dumps(proper_name_udf().func))
    code = (
        "import sys, pandas as pd\n"
        "from pyspark import cloudpickle\n"
        f"function = cloudpickle.loads(open({str(shipped)!r}, 'rb').read())\n"
        "assert list(function(pd.Series(['A,B']))) == ['A, B']\n"
        "assert 'millrace' not in sys.modules\n"
    )
    environment = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=environment, timeout=120)


def test_tiers_at_their_limits(spark):
    df = spark.createDataFrame([(v,) for v in ("500", "499.99", "100", "99.99", None)], "v STRING")
    amount = F.col("v").cast("decimal(10,2)")
    found = {row.v: row.t for row in df.select("v", value_tier(amount).alias("t")).collect()}
    assert found == {"500": "High", "499.99": "Medium", "100": "Medium", "99.99": "Low", None: "Low"}


def test_speeds_at_their_limits(spark):
    df = spark.createDataFrame([(3.0,), (3.1,), (10.0,), (10.1,), (None,)], "v DOUBLE")
    found = {row.v: row.s for row in df.select("v", response_speed("v").alias("s")).collect()}
    assert found == {3.0: "Fast", 3.1: "Normal", 10.0: "Normal", 10.1: "Slow", None: "Slow"}


def test_longer_names_are_kept_whole_in_report_lines(spark):
    df = spark.createDataFrame([("n" * 40, "k"), ("short", "k")], "name STRING, kind STRING")
    lines = [row.line for row in df.select(report_line("Zone", "name", "Type", "kind").alias("line")).collect()]
    assert lines == [f"Zone: {'n' * 40} | Type: k", f"Zone: {'short':<35} | Type: k"]


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)"])
def test_exact_totals(spark, kind):
    amounts = [0.1, 0.2, 277.46, 277.47, -5.55, None]
    df = spark.createDataFrame([(a,) for a in amounts], "v DOUBLE").withColumn("v", F.col("v").cast(kind))
    total = df.agg(exact_total(df, "v", 2).alias("t")).first().t
    assert str(total) == "549.68"


def test_exact_totals_of_other_scales_and_odd_amounts(spark):
    def total(values, scale):
        df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
        return df.agg(exact_total(df, "v", scale).alias("t")).first().t

    assert str(total([0.004, 0.004, 0.004, 0.125], 3)) == "0.137"
    assert total([1.0, float("nan")], 2) is None and total([1.0, float("inf")], 2) is None
    assert total([None], 2) is None
    # Past the range of a long of cents.
    assert total([9e14] * 200, 2) == 9 * 10**14 * 200
    assert total([-9e14] * 200 + [0.01], 2) == Decimal("0.01") - 9 * 10**14 * 200


def test_totals_are_plain_sums_unless_a_scale_is_given(spark):
    df = spark.createDataFrame([("a", 0.004), ("a", 0.125), ("a", None)], "k STRING, v DOUBLE")
    row = totals(df, "k", "v").first()
    assert (row.n_rows, row.n_known) == (3, 2) and row.total == pytest.approx(0.129)
    assert str(totals(df, "k", "v", scale=3).first().total) == "0.129"


def test_average_of_a_tie_rounds_up(spark):
    df = spark.createDataFrame([(277.46,), (277.47,)], "v DOUBLE")
    assert str(df.agg(mean(exact_total(df, "v", 2), F.count("v")).alias("m")).first().m) == "277.47"


def test_null_rules(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "s STRING, n INT")
    assert df.filter(F.col("s") == "a").count() == 1
    assert df.filter(F.col("s") != "a").count() == 1
    assert df.filter(F.col("s").isNull()).count() == 1
    assert df.filter(F.col("s").isNotNull()).count() == 2
    assert [r.x for r in df.select(F.concat("s", F.lit(" "), F.lit("t")).alias("x")).collect()] == ["a t", None, "b t"]
    assert df.agg(F.count_distinct("s")).first()[0] == 2
    assert df.select(F.when(F.col("s") == "a", "yes").otherwise("no").alias("x")).filter("x = 'no'").count() == 2
