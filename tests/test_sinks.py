import pytest
from pyspark.sql import functions as F

from millrace.sinks.verify import differing_buckets, differing_rows, fingerprint, verify
from millrace.sources.jdbc import Database


@pytest.fixture
def part(tables):
    return tables.part


def test_error_mode_is_the_default_and_raises(part, tmp_path):
    path = str(tmp_path / "out")
    part.write.parquet(path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        part.write.parquet(path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        part.write.mode("error").csv(path)


def test_overwrite_replaces(spark, part, tmp_path):
    path = str(tmp_path / "out")
    part.write.csv(path, header=True)
    part.filter("p_size < 5").write.mode("overwrite").csv(path, header=True)
    assert spark.read.csv(path, header=True).count() == part.filter("p_size < 5").count()


def test_text_takes_one_string_column(part, tmp_path):
    with pytest.raises(Exception):
        part.select("p_size").write.text(str(tmp_path / "a"))
    with pytest.raises(Exception):
        part.select("p_name", "p_type").write.text(str(tmp_path / "b"))


def test_verify_ignores_order_and_sees_changes(part):
    assert verify(part, part.orderBy(F.desc("p_name"))).first() == (part.count(), part.count(), True)
    changed = part.withColumn("p_size", F.when(F.col("p_partkey") == 3, 99).otherwise(F.col("p_size")))
    assert not verify(part, changed).first().same_rows
    # The same number of rows and the same distinct rows, but other duplicates.
    small = part.limit(2).orderBy("p_partkey").collect()
    one = part.sparkSession.createDataFrame([small[0], small[0], small[1]], part.schema)
    other = part.sparkSession.createDataFrame([small[0], small[1], small[1]], part.schema)
    assert not verify(one, other).first().same_rows


def test_verify_sees_values_that_changed_column(spark):
    def table(*found):
        return spark.createDataFrame(found, "a INT, b INT")

    assert not verify(table((1, None), (5, 6)), table((None, 1), (5, 6))).first().same_rows
    assert not verify(table((1, 2), (3, 4)), table((2, 1), (3, 4))).first().same_rows
    assert not verify(table((1, 2), (3, 4)), table((1, 4), (3, 2))).first().same_rows
    dotted = table((1, None)).toDF("a.b", "c`d")
    assert verify(dotted, dotted).first() == (1, 1, True)


def test_verify_of_nothing(part):
    empty = part.filter("p_size < 0")
    assert verify(empty, empty).first() == (0, 0, True)
    assert not verify(empty, part).first().same_rows
    assert fingerprint(empty).first().n_rows == 0


def test_one_changed_row_of_a_million_is_found(spark):
    written = spark.range(1_000_000).select("id", (F.col("id") % 7).cast("int").alias("v"), F.when(F.col("id") % 3 > 0, "x").alias("side"))
    found = written.withColumn("v", F.when(F.col("id") == 777_777, None).otherwise(F.col("v")))
    assert differing_buckets(written, found).count() in (1, 2)
    rows = {tuple(row) for row in differing_rows(written.drop("side"), found.drop("side")).collect()}
    assert rows == {(777_777, 777_777 % 7, "written", 1), (777_777, None, "found", 1)}


def test_differing_rows_counts_repeats_and_treats_nulls_as_equal(spark):
    def table(*found):
        return spark.createDataFrame(found, "a INT, `b.c` STRING")

    one = table((1, "x"), (1, "x"), (None, None), (2, None))
    other = table((1, "x"), (None, None), (2, ""), (3, "y"), (3, "y"))
    rows = sorted((tuple(r) for r in differing_rows(one, other).collect()), key=str)
    assert rows == sorted([(1, "x", "written", 1), (2, None, "written", 1), (2, "", "found", 1), (3, "y", "found", 2)], key=str)
    assert differing_rows(one, one).count() == 0 and differing_rows(one.limit(0), other.limit(0)).count() == 0
    assert differing_rows(one, other.limit(0)).agg(F.sum("times")).first()[0] == 4


# The database below is embedded in the Spark process; nothing listens on a port.


@pytest.fixture
def database(spark):
    return Database.of(spark)


def test_jdbc_modes(spark, database, tables, rows):
    suppliers, types = tables.supplier, "s_name VARCHAR(100)"
    database.write(suppliers, "modes", "overwrite", types)
    with pytest.raises(Exception, match="already exists"):
        database.write(suppliers, "modes", "error", types)
    database.write(suppliers, "modes", "ignore", types)
    assert rows(database.read_table("modes")) == rows(suppliers)
    database.write(suppliers, "modes", "append", types)
    assert database.read_table("modes").count() == 2 * suppliers.count()
    database.write(suppliers.limit(1), "modes", "overwrite", types)
    assert database.read_table("modes").count() == 1


def test_jdbc_filter_reaches_the_database(database, tables, plan):
    database.write(tables.supplier, "pushed", "overwrite", "s_name VARCHAR(100)")
    assert "PushedFilters: [*" in plan(database.read_table("pushed").filter("s_suppkey > 3"))


def test_jdbc_split_read_is_whole(database, tables, rows, spark):
    holes = tables.supplier.withColumn(
        "s_nationkey", F.when(F.col("s_suppkey") > 3, F.col("s_nationkey"))
    )
    database.write(holes, "split", "overwrite", "s_name VARCHAR(100)")
    read = database.read_split("split", "s_nationkey", 3)
    assert read.rdd.getNumPartitions() <= 4
    assert rows(read) == rows(holes)


def sizes(df):
    return df.select(F.spark_partition_id().alias("p")).groupBy("p").count()


def test_jdbc_split_parts_are_even_where_keys_crowd(database, spark, rows):
    crowded = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") / 30).otherwise(F.col("id") * 10).cast("bigint").alias("k"), F.col("id").alias("pk"),
        F.concat(F.lit("it's "), F.col("id").cast("string")).alias("name"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("day"),
    )
    database.write(crowded, "crowded", "overwrite", "name VARCHAR(50)")
    for columns in ("k", "name", "day", ("k", "pk"), ("name", "k")):
        read = database.read_split("crowded", columns, 8)
        assert rows(read) == rows(crowded)
        counts = [r["count"] for r in sizes(read).collect()]
        assert len(counts) == 8 and max(counts) <= 2 * 3000 / 8


def test_jdbc_split_divides_a_hot_key_by_further_columns(database, spark, rows):
    hot = spark.range(900).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                  F.when(F.col("id") % 5 != 0, F.col("id")).alias("tie"), F.col("id").alias("pk"))
    database.write(hot, "hot_key", "overwrite", "k VARCHAR(20)")
    read = database.read_split("hot_key", ("k", "pk"), 6)
    assert rows(read) == rows(hot) and max(r["count"] for r in sizes(read).collect()) <= 2 * 900 / 6
    assert rows(database.read_split("hot_key", ("k", "tie"), 6)) == rows(hot)
    assert rows(database.read_split("hot_key", "k", 1)) == rows(hot)


def test_a_load_that_fails_leaves_the_old_rows(database, tables, rows):
    database.write(tables.supplier, "kept_rows", "overwrite", "s_name VARCHAR(100)")
    last = tables.supplier.agg(F.max("s_suppkey")).first()[0]
    breaking = tables.supplier.repartition(4).withColumn(
        "s_acctbal", F.when(F.col("s_suppkey") == last, F.raise_error(F.lit("half-way")).cast("double")).otherwise(F.col("s_acctbal"))
    )
    with pytest.raises(Exception, match="half-way"):
        database.replace(breaking, "kept_rows", "s_name VARCHAR(100)")
    assert rows(database.read_table("kept_rows")) == rows(tables.supplier)
    # What is left of it is overwritten by the next load.
    assert database.replace(tables.supplier.limit(2), "kept_rows", "s_name VARCHAR(100)").first().same_rows
    assert database.read_table("kept_rows").count() == 2 and not database.has("kept_rows_staged") and not database.has("kept_rows_old")


def test_a_load_that_the_database_changes_is_not_taken(database, tables, rows):
    database.write(tables.supplier, "exact_rows", "overwrite", "s_name VARCHAR(100)")
    halves = tables.supplier.withColumn("s_acctbal", F.col("s_acctbal") + 0.001)
    check = database.replace(halves, "exact_rows", "s_name VARCHAR(100), s_acctbal DECIMAL(12,2)").first()
    assert not check.same_rows and check.rows_written == check.rows_found
    assert rows(database.read_table("exact_rows")) == rows(tables.supplier) and not database.has("exact_rows_staged")


def test_a_swap_happens_whole_or_not_at_all(database, tables):
    database.write(tables.supplier.limit(1), "swap_a", "overwrite", "s_name VARCHAR(100)")
    with pytest.raises(Exception):
        database.in_one_transaction(database._rename("swap_a", "swap_b"), "DROP TABLE no_such_table")
    assert database.has("swap_a") and not database.has("swap_b")


def test_a_first_load_needs_no_old_table(database, tables):
    if database.has("first_load"):
        database.drop("first_load")
    assert database.replace(tables.supplier, "first_load", "s_name VARCHAR(100)").first().same_rows
    assert database.read_table("first_load").count() == tables.supplier.count()


def test_jdbc_split_read_of_an_empty_table(database, tables):
    database.write(tables.supplier.filter("s_suppkey < 0"), "no_suppliers", "overwrite", "s_name VARCHAR(100)")
    assert database.read_split("no_suppliers", "s_suppkey", 3).count() == 0


def test_configured_database_is_used(spark):
    spark.conf.set("spark.millrace.jdbc.url", "jdbc:example:shop")
    spark.conf.set("spark.millrace.jdbc.user", "someone")
    try:
        assert Database.of(spark).options == {"url": "jdbc:example:shop", "user": "someone"}
    finally:
        spark.conf.unset("spark.millrace.jdbc.url")
        spark.conf.unset("spark.millrace.jdbc.user")
