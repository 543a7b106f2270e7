"""Layout and reuse queries: the same totals after every redistribution."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import CENTS, exact_total
from millrace.operators.aggregates import distinct_totals
from millrace.operators.layout import (
    by_hash,
    by_range,
    merged,
    numbered,
    partition_stats,
    read_width,
    round_robin,
    rows_of_partition,
    shuffle_width,
)
from millrace.operators.reuse import persisted, storage_held, write_each
from millrace.plans.registry import query
from millrace.plans.sqltext import exact_sum
from millrace.session import scoped_session, scratch_path
from millrace.sources.files import read_csv
from millrace.sources.tables import Tables

# The smallest widths used; a session with a larger shuffle width gets that.
LAYOUT_WIDTH, SHUFFLE_WIDTH, READ_SPLIT = 14, 3, "64m"


def supplier_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("l_suppkey").agg(
        F.count("*").alias("n_lines"), exact_total(lines, "l_extendedprice", CENTS).cast("double").alias("total")
    )


_TOTALS_SQL = f"""
    SELECT l_suppkey, COUNT(*) AS n_lines, {exact_sum('l_extendedprice')} AS total FROM lineitem GROUP BY l_suppkey
"""


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice")


def _width(t: Tables) -> int:
    return max(LAYOUT_WIDTH, shuffle_width(t.spark))


@query(_TOTALS_SQL)
def lay_read_split(t: Tables) -> DataFrame:
    spark = scoped_session(t.spark, {"spark.sql.files.maxPartitionBytes": READ_SPLIT})
    return supplier_totals(_lines(t.on(spark)))


@query(_TOTALS_SQL)
def lay_shuffle_width(t: Tables) -> DataFrame:
    width = max(SHUFFLE_WIDTH, shuffle_width(t.spark))
    spark = scoped_session(t.spark, {"spark.sql.shuffle.partitions": str(width)})
    return supplier_totals(_lines(t.on(spark)))


@query(_TOTALS_SQL)
def lay_round_robin(t: Tables) -> DataFrame:
    return supplier_totals(round_robin(_lines(t), _width(t)))


@query(_TOTALS_SQL)
def lay_hash(t: Tables) -> DataFrame:
    return supplier_totals(by_hash(_lines(t), _width(t), "l_suppkey"))


@query(_TOTALS_SQL)
def lay_range(t: Tables) -> DataFrame:
    return supplier_totals(by_range(_lines(t), _width(t), "l_suppkey"))


@query("SELECT COUNT(*) AS n_rows, TRUE AS third_is_part FROM lineitem")
def flt_partition(t: Tables) -> DataFrame:
    """A predicate on the physical partition: the third range holds some rows, the others the rest."""
    laid = by_range(_lines(t), _width(t), "l_suppkey")
    in_third = numbered(laid).select((F.col("partition_number") == 2).alias("in_third"))
    return in_third.agg(
        F.count("*").alias("n_rows"), (F.bool_or("in_third") & ~F.bool_and("in_third")).alias("third_is_part")
    )


@query("SELECT TRUE AS has_rows, TRUE AS has_not_all FROM lineitem LIMIT 1")
def flt_partition_rows(t: Tables) -> DataFrame:
    """The rows of the third range: some, and not all."""
    lines = _lines(t)
    third = rows_of_partition(by_range(lines, _width(t), "l_suppkey"), 2).select(F.lit(1).alias("third"))
    both = third.unionByName(lines.select(F.lit(0).alias("third")))
    inside = F.sum("third")
    return both.agg((inside > 0).alias("has_rows"), (2 * inside < F.count("*")).alias("has_not_all"))


@query("""
    SELECT layout, COUNT(*) AS n_rows, TRUE AS all_used, TRUE AS even
    FROM lineitem, (VALUES ('round robin'), ('hash'), ('range')) AS l(layout) GROUP BY layout
""")
def lay_skew_report(t: Tables) -> DataFrame:
    """Each layout: its rows, whether every partition has some, and whether none has three times the average."""
    lines, width = _lines(t), _width(t)
    layouts = {
        "round robin": round_robin(lines, width),
        "hash": by_hash(lines, width, "l_orderkey"),
        "range": by_range(lines, width, "l_orderkey"),
    }
    reports = [
        partition_stats(laid, "l_orderkey").agg(
            F.sum("record_count").alias("n_rows"),
            (F.count("*") == width).alias("all_used"),
            (F.max("record_count") * width < 3 * F.sum("record_count")).alias("even"),
        ).select(F.lit(name).alias("layout"), "n_rows", "all_used", "even")
        for name, laid in layouts.items()
    ]
    return reports[0].unionAll(reports[1]).unionAll(reports[2])


@query(_TOTALS_SQL)
def lay_coalesce(t: Tables) -> DataFrame:
    lines = _lines(t)
    return supplier_totals(merged(lines, max(1, read_width(lines) // 2)))


@query("SELECT COUNT(*) AS n_rows, MIN(l_suppkey) AS min_key, MAX(l_suppkey) AS max_key FROM lineitem")
def lay_partition_stats(t: Tables) -> DataFrame:
    """Statistics per partition, rolled up, since the partitions themselves vary."""
    stats = partition_stats(_lines(t), "l_suppkey")
    return stats.agg(
        F.sum("record_count").alias("n_rows"), F.min("min_value").alias("min_key"), F.max("max_value").alias("max_key")
    )


@query("""
    SELECT 'user' AS report, CAST(user_id AS VARCHAR) AS label, COUNT(*) AS n FROM events
    WHERE event_type = 'error' GROUP BY user_id
    UNION ALL
    SELECT 'day', CAST(CAST(ts AS DATE) AS VARCHAR), COUNT(*) FROM events
    WHERE event_type = 'error' GROUP BY CAST(ts AS DATE)
""")
def lay_cached_reuse(t: Tables) -> DataFrame:
    """Two reports over one kept subset, released once both are written."""
    subset = t.events.filter(F.col("event_type") == "error").select("user_id", "ts")
    path = scratch_path(t.spark, "reports")
    with persisted(subset) as errors:
        for report, label in (("user", F.col("user_id")), ("day", F.to_date("ts"))):
            counts = errors.groupBy(label.cast("string").alias("label")).agg(F.count("*").alias("n"))
            counts.select(F.lit(report).alias("report"), "label", "n").write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


#: Levels by name. Python's plain levels hold serialized rows already.
STORAGE_LEVELS = {
    "memory": StorageLevel.MEMORY_ONLY, "disk": StorageLevel.DISK_ONLY, "memory and disk": StorageLevel.MEMORY_AND_DISK,
    "memory, objects": StorageLevel.MEMORY_AND_DISK_DESER, "disk, twice": StorageLevel.DISK_ONLY_2,
}


@query("""
    SELECT level, n_rows, TRUE AS whole, level NOT LIKE 'disk%' AS in_memory, level LIKE 'disk%' AS on_disk, TRUE AS released
    FROM (SELECT COUNT(*) AS n_rows FROM orders), (VALUES ('memory'), ('disk'), ('memory and disk'), ('memory, objects'), ('disk, twice')) AS l(level)
""")
def lay_storage_levels(t: Tables) -> DataFrame:
    """Each storage level: the rows kept, whether all were, where, and whether they were released.

    Where memory is short, Spark leaves partitions out of memory or moves them to disk, and the
    report says so.
    """
    found = [(name, *storage_held(t.orders.select("o_orderkey", "o_custkey"), level).values()) for name, level in STORAGE_LEVELS.items()]
    return t.spark.createDataFrame(found, "level STRING, n_rows BIGINT, whole BOOLEAN, in_memory BOOLEAN, on_disk BOOLEAN, released BOOLEAN")


@query(f"""
    WITH totals AS (SELECT l_suppkey, {exact_sum('l_extendedprice')} AS total
                    FROM (SELECT DISTINCT * FROM lineitem) GROUP BY l_suppkey)
    SELECT 'first' AS output, l_suppkey, total FROM totals
    UNION ALL SELECT 'second', l_suppkey, total FROM totals
""")
def lay_persist_two_sinks(t: Tables) -> DataFrame:
    """Totals without duplicate lines, computed once and written to two CSV outputs."""
    paths = {name: scratch_path(t.spark, name) for name in ("first", "second")}
    write_each(
        distinct_totals(t.lineitem, "l_suppkey", "l_extendedprice", CENTS),
        *(lambda df, path=path: df.write.mode("overwrite").csv(path, header=True) for path in paths.values()),
    )
    first, second = (
        read_csv(t.spark, path, "l_suppkey BIGINT, total DECIMAL(28,2)").select(
            F.lit(name).alias("output"), "l_suppkey", F.col("total").cast("double").alias("total")
        )
        for name, path in paths.items()
    )
    return first.unionAll(second)
