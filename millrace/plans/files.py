"""File sources and sinks: tables written through a sink and read back through a source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import report_line
from millrace.operators.joins import join_broadcasting
from millrace.operators.outcomes import outcome
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sinks.verify import differing_rows, verify
from millrace.sources.files import read_csv, read_lines
from millrace.sources.tables import Tables

PART_SCHEMA = (
    "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
)


def _written_csv(t: Tables, label: str, header: bool = True) -> str:
    path = scratch_path(t.spark, label)
    t.part.write.mode("overwrite").csv(path, header=header)
    return path


@query("SELECT * FROM part")
def src_csv_infer_noheader(t: Tables) -> DataFrame:
    rows = read_csv(t.spark, _written_csv(t, "csv", header=False), header=False)
    # Inferred types are the narrowest that fit, so they grow with the data.
    named = rows.toDF(*t.part.columns)
    return named.select(*(F.col(f.name).cast(f.dataType) for f in t.part.schema))


@query("SELECT p_partkey AS id, p_name AS label, p_brand, p_type, p_size, p_retailprice AS price FROM part")
def src_csv_schema(t: Tables) -> DataFrame:
    schema = PART_SCHEMA.replace("p_partkey", "id").replace("p_name", "label").replace("p_retailprice", "price")
    return read_csv(t.spark, _written_csv(t, "csv"), schema)


@query("SELECT * FROM part")
def src_csv_infer(t: Tables) -> DataFrame:
    rows = read_csv(t.spark, _written_csv(t, "csv"))
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in t.part.schema))


@query("SELECT p_partkey || ';' || p_name AS line FROM part")
def src_text_lines(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lines")
    t.part.select(F.concat_ws(";", "p_partkey", "p_name")).write.mode("overwrite").text(path)
    return read_lines(t.spark, path).withColumnRenamed("value", "line")


# Rank of each order priority.
PRIORITY_RANKS = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query("SELECT CAST(o_orderpriority[1] AS INTEGER) AS rank, COUNT(*) AS n_orders FROM orders GROUP BY rank")
def src_local_rows(t: Tables) -> DataFrame:
    ranks = t.spark.createDataFrame(PRIORITY_RANKS, "priority STRING, rank INT")
    per_priority = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    ranked = join_broadcasting(per_priority, ranks, F.col("o_orderpriority") == F.col("priority"))
    return ranked.groupBy("rank").agg(F.sum("n").alias("n_orders"))


@query("SELECT * FROM part")
def snk_csv_roundtrip(t: Tables) -> DataFrame:
    return read_csv(t.spark, _written_csv(t, "csv"), PART_SCHEMA)


@query("SELECT p_name AS value FROM part")
def snk_text_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "names")
    t.part.select("p_name").write.mode("overwrite").text(path)
    return read_lines(t.spark, path)


@query("SELECT * FROM orders")
def snk_parquet_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders")
    t.orders.write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("SELECT * FROM part UNION ALL SELECT * FROM part")
def snk_append(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parts")
    t.part.write.mode("append").parquet(path)
    t.part.write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query("SELECT * FROM part WHERE p_size < 10")
def snk_ignore(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parts")
    t.part.filter(F.col("p_size") < 10).write.mode("ignore").parquet(path)
    t.part.write.mode("ignore").parquet(path)
    return t.spark.read.parquet(path)


@query("""
    SELECT 'first' AS step, COUNT(*) AS n_rows, NULL::VARCHAR AS error_class FROM part
    UNION ALL SELECT 'again', NULL, 'PATH_ALREADY_EXISTS'
    UNION ALL SELECT 'left', COUNT(*), NULL FROM part
""")
def snk_error_if_exists(t: Tables) -> DataFrame:
    """A table written twice in the default mode: the second write is an error and leaves the first alone."""
    path = scratch_path(t.spark, "parts")

    def write(rows: DataFrame) -> int:
        rows.write.mode("error").parquet(path)
        return t.spark.read.parquet(path).count()

    steps = (
        ("first", lambda: write(t.part)), ("again", lambda: write(t.part.filter(F.col("p_size") < 10))),
        ("left", lambda: t.spark.read.parquet(path).count()),
    )
    found = [outcome(t.spark, label, step) for label, step in steps]
    return found[0].unionAll(found[1]).unionAll(found[2])


@query("SELECT COUNT(*) AS rows_written, COUNT(*) AS rows_found, TRUE AS same_rows FROM orders")
def snk_verify(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders")
    t.orders.write.mode("overwrite").parquet(path)
    return verify(t.orders, t.spark.read.parquet(path))


@query("""
    SELECT o_orderkey, o_totalprice, 'written' AS side, 1::BIGINT AS times FROM orders WHERE o_orderkey % 1000 = 7
    UNION ALL SELECT o_orderkey, o_totalprice + 0.5, 'found', 1 FROM orders WHERE o_orderkey % 1000 = 7
    UNION ALL SELECT o_orderkey, o_totalprice, 'found', 1 FROM orders WHERE o_orderkey % 1000 = 9
""")
def snk_differences(t: Tables) -> DataFrame:
    """A written copy in which a few amounts have changed and a few rows stand twice: which rows these are."""
    path = scratch_path(t.spark, "orders")
    orders = t.orders.select("o_orderkey", "o_totalprice")
    group = F.col("o_orderkey") % 1000
    changed = orders.withColumn("o_totalprice", F.when(group == 7, F.col("o_totalprice") + 0.5).otherwise(F.col("o_totalprice")))
    changed.unionAll(orders.filter(group == 9)).write.mode("overwrite").parquet(path)
    return differing_rows(orders, t.spark.read.parquet(path))


@query("""
    SELECT printf('Part: %-35s | Type: %s', p_name, p_type) AS line FROM part
    WHERE p_type = 'PROMO' AND p_size >= 25
""")
def rdd_lines(t: Tables) -> DataFrame:
    """Lines of a CSV file with headers: split, skip the headers, filter, format; no shuffle."""
    fields = read_lines(t.spark, _written_csv(t, "csv")).select(F.split("value", ",").alias("field"))
    rows = fields.filter(F.col("field")[0] != "p_partkey")
    chosen = rows.filter(F.col("field")[3] == "PROMO").filter(F.col("field")[4].try_cast("int") >= 25)
    return chosen.select(F.col("field")[1].alias("name"), F.col("field")[3].alias("kind")).select(
        report_line("Part", "name", "Type", "kind").alias("line")
    )
