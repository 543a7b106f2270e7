"""Partly broken JSON: reading, telling good from bad, report and error log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.quality import malformed_lines, valid_records
from millrace.operators.outcomes import outcome
from millrace.operators.reuse import persisted
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.files import CORRUPT_COLUMN, PLACE_COLUMN, read_json_lines, read_lines
from millrace.sources.schemas import CHECKED_PEOPLE, PEOPLE
from millrace.sources.tables import Tables


def with_city(records: DataFrame) -> DataFrame:
    return records.withColumn("city", F.col("details.address.city"))


def city_counts(valid: DataFrame) -> DataFrame:
    """Valid records per ``city``, most frequent first."""
    return valid.groupBy("city").count().orderBy(F.desc("count"), "city")


def flat_people(records: DataFrame) -> DataFrame:
    """``id, name, age, city``, and what else must be known of a record."""
    flat = (F.col("id"), F.col("name"), F.col("details.age").alias("age"), F.col("details.address.city").alias("city"))
    return records.select(*flat, CORRUPT_COLUMN, PLACE_COLUMN)


def quarantine(records: DataFrame, clean: str, log: str, report: str) -> None:
    """Split the placed records of ``read_json_lines``: the valid ones flat and counted by city, the lines of the others.

    The log has every broken line as it is, each as often as the input has it. All outputs come from one parse. Only the columns they need are kept for that, and they are
    released afterwards.
    """
    with persisted(flat_people(records)) as kept:
        valid = valid_records(kept).drop(PLACE_COLUMN)
        valid.write.mode("overwrite").parquet(clean)
        malformed_lines(kept).write.mode("overwrite").text(log)
        city_counts(valid).write.mode("overwrite").parquet(report)


def record_lines(t: Tables) -> DataFrame:
    """Orders as JSON lines.

    Lines of open-ended status ``P`` occur twice and lack their last brace, the low ones among
    them stand in an array whose second record is broken. Urgent finished orders have a text
    where the details belong, low ones of other states stand in an array with a second record.
    """
    details = F.struct(
        F.year("o_orderdate").alias("age"),
        F.struct(
            F.concat(F.lit("street "), "o_custkey").alias("street"), F.col("o_orderpriority").alias("city")
        ).alias("address"),
    )
    base = (F.col("o_orderkey").alias("id"), F.concat(F.lit("order "), "o_orderkey").alias("name"))
    whole = F.to_json(F.struct(*base, details.alias("details")))
    second = F.struct((-F.col("o_orderkey") - 1).alias("id"), F.lit("second").alias("name"), details.alias("details"))
    pair = F.to_json(F.array(F.struct(*base, details.alias("details")), second))
    half = F.concat(F.lit("["), whole, F.lit(',{"id":'), -F.col("o_orderkey") - 1, F.lit(',"details":"wrong"}]'))
    mistyped = F.to_json(F.struct(*base, F.lit("wrong").alias("details")))
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    open_ended, low = F.col("o_orderstatus") == "P", F.col("o_orderpriority") == "5-LOW"
    line = F.when(open_ended & low, half).when(open_ended, F.regexp_replace(whole, r"\}$", "")).when(urgent, mistyped).when(low, pair).otherwise(whole)
    return t.orders.select(F.explode(F.array_repeat(line, F.when(open_ended, 2).otherwise(1))).alias("value"))


def record_files(t: Tables) -> str:
    path = scratch_path(t.spark, "records")
    record_lines(t).write.mode("overwrite").text(path)
    return path


_WHOLE = """'{"id":' || o_orderkey || ',"name":"order ' || o_orderkey || '","details":{"age":'
    || year(o_orderdate) || ',"address":{"street":"street ' || o_custkey || '","city":"' || o_orderpriority"""
_CUT_TEXT = f"""{_WHOLE} || '"}}}}'"""
_HALF_TEXT = f"""'[' || {_WHOLE} || '"}}}}}},{{"id":' || (-o_orderkey - 1) || ',"details":"wrong"}}]'"""
_BROKEN_TEXT = f"CASE WHEN o_orderpriority = '5-LOW' THEN {_HALF_TEXT} ELSE {_CUT_TEXT} END"
_MISTYPED_TEXT = """'{"id":' || o_orderkey || ',"name":"order ' || o_orderkey || '","details":"wrong"}'"""
_MISTYPED = "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
_PAIRED = "o_orderstatus <> 'P' AND o_orderpriority = '5-LOW'"
_SECOND = f"""SELECT -o_orderkey - 1 AS id, 'second' AS name, CAST(year(o_orderdate) AS INTEGER) AS age,
    o_orderpriority AS city FROM orders WHERE {_PAIRED}"""
_VALID = f"o_orderstatus <> 'P' AND NOT ({_MISTYPED})"
_TWICE = "(SELECT unnest([1, 2]))"


@query(f"""
    SELECT o_orderkey AS id, CASE WHEN {_VALID} THEN o_orderpriority END AS city,
           CASE WHEN {_MISTYPED} THEN {_MISTYPED_TEXT} END AS raw_text
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT -o_orderkey - 1, o_orderpriority, NULL FROM orders WHERE {_PAIRED}
    UNION ALL SELECT CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey END,
                     CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority END, {_BROKEN_TEXT}
    FROM orders, {_TWICE} WHERE o_orderstatus = 'P'
    UNION ALL SELECT -o_orderkey - 1, NULL, {_BROKEN_TEXT} FROM orders, {_TWICE}
    WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
""")
def src_json_permissive(t: Tables) -> DataFrame:
    records = read_json_lines(t.spark, record_files(t), CHECKED_PEOPLE)
    return records.select("id", F.col("details.address.city").alias("city"), F.col(CORRUPT_COLUMN).alias("raw_text"))


@query(f"""
    SELECT o_orderkey AS id, 'order ' || o_orderkey AS name, CAST(year(o_orderdate) AS INTEGER) AS age,
           o_orderpriority AS city FROM orders WHERE {_VALID}
    UNION ALL {_SECOND}
""")
def src_json_dropmalformed(t: Tables) -> DataFrame:
    records = read_json_lines(t.spark, record_files(t), PEOPLE, mode="DROPMALFORMED")
    return records.select("id", "name", F.col("details.age").alias("age"), F.col("details.address.city").alias("city"))


@query(f"""
    WITH clean AS (
        SELECT o_orderkey AS id, 'order ' || o_orderkey AS name, CAST(year(o_orderdate) AS INTEGER) AS age,
               o_orderpriority AS city FROM orders WHERE {_VALID}
        UNION ALL {_SECOND})
    SELECT 'clean' AS kind, name AS label, id, age, city, 1 AS n FROM clean
    UNION ALL SELECT 'city', city, NULL, NULL, city, COUNT(*) FROM clean GROUP BY city
    UNION ALL SELECT 'malformed', {_MISTYPED_TEXT}, NULL, NULL, NULL, 1 FROM orders WHERE {_MISTYPED}
    UNION ALL SELECT 'malformed', {_BROKEN_TEXT}, NULL, NULL, NULL, 1 FROM orders, {_TWICE} WHERE o_orderstatus = 'P'
""")
def job_quarantine(t: Tables) -> DataFrame:
    """The outputs of the job: each clean record, counts per city, and each line of the error log."""
    clean, log, report = (scratch_path(t.spark, label) for label in ("clean", "log", "report"))
    quarantine(read_json_lines(t.spark, record_files(t), CHECKED_PEOPLE, placed=True), clean, log, report)

    def output(kind: str, rows: DataFrame, **columns: Column) -> DataFrame:
        kinds = {"label": "string", "id": "bigint", "age": "int", "city": "string", "n": "bigint"}
        found = {name: columns.get(name, F.lit(None)).cast(of).alias(name) for name, of in kinds.items()}
        return rows.select(F.lit(kind).alias("kind"), *found.values())

    one, city = F.lit(1), F.col("city")
    records = output("clean", t.spark.read.parquet(clean), label=F.col("name"), id=F.col("id"), age=F.col("age"), city=city, n=one)
    counts = output("city", t.spark.read.parquet(report), label=city, city=city, n=F.col("count"))
    return records.unionAll(counts).unionAll(output("malformed", read_lines(t.spark, log), label=F.col("value"), n=one))


@query(f"""
    SELECT 'good lines' AS step, (SELECT COUNT(*) FROM orders WHERE {_VALID}) + (SELECT COUNT(*) FROM orders WHERE {_PAIRED}) AS n_rows,
           NULL::VARCHAR AS error_class
    UNION ALL SELECT 'all lines', NULL, 'MALFORMED_RECORD_IN_PARSING.WITHOUT_SUGGESTION' FROM (SELECT 1) WHERE EXISTS (SELECT * FROM orders WHERE NOT ({_VALID}))
    UNION ALL SELECT 'all lines', (SELECT COUNT(*) FROM orders), NULL FROM (SELECT 1) WHERE NOT EXISTS (SELECT * FROM orders WHERE NOT ({_VALID}))
""")
def src_json_failfast(t: Tables) -> DataFrame:
    """Reading that stops at the first broken record: whole over the good lines, an error over all of them."""
    path, good = record_files(t), scratch_path(t.spark, "good-records")
    checked = read_json_lines(t.spark, path, CHECKED_PEOPLE)
    valid_records(checked).select(F.to_json(F.struct("*")).alias("value")).write.text(good)

    def read(folder: str) -> int:
        # All fields are parsed into rows; a count alone would need none of them.
        return read_json_lines(t.spark, folder, PEOPLE, mode="FAILFAST").select(F.xxhash64(F.to_json(F.struct("*"))).alias("h")).agg(F.count("h")).first()[0]

    return outcome(t.spark, "good lines", lambda: read(good)).unionAll(outcome(t.spark, "all lines", lambda: read(path)))
