import pytest
from pyspark.sql import functions as F

from millrace.operators.joins import _rooted, fits, join_copartitioned, pair_totals
from millrace.operators.layout import (
    by_hash,
    by_range,
    hot_spread,
    in_order,
    merged,
    partition_stats,
    read_width,
    round_robin,
    row_mark,
    rows_of_partition,
)


@pytest.fixture
def even(spark):
    return spark.range(0, 6000, numPartitions=3).select((F.col("id") % 60).alias("k"), F.col("id").alias("v"))


@pytest.fixture
def hot(spark):
    """A third of the rows have key 7, and some have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 100)
    return spark.range(0, 9000, numPartitions=3).select(key.alias("k"), F.col("id").alias("v"))


def placed(df):
    return df.withColumn("p", F.spark_partition_id())


def test_round_robin_is_even(hot):
    sizes = [r["record_count"] for r in partition_stats(round_robin(hot, 14), "k").collect()]
    assert len(sizes) == 14 and max(sizes) - min(sizes) <= 3


def test_hash_keeps_equal_keys_together(even):
    spread = placed(by_hash(even, 8, "k")).groupBy("k").agg(F.count_distinct("p").alias("n"))
    assert {r["n"] for r in spread.collect()} == {1}


def test_hash_spreads_only_the_hot_key(hot, rows):
    laid = by_hash(hot, 8, "k")
    parts = {r["k"]: r["n"] for r in placed(laid).groupBy("k").agg(F.count_distinct("p").alias("n")).collect()}
    assert parts.pop(7) > 1
    assert set(parts.values()) == {1}
    assert rows(laid) == rows(hot)
    largest = max(r["record_count"] for r in partition_stats(laid, "k").collect())
    assert largest < 3000  # the hot key alone has 3000 rows


def test_range_is_contiguous_and_ordered(even):
    stats = partition_stats(by_range(even, 6, "k"), "k").collect()
    for one, after in zip(stats, stats[1:]):
        assert one["max_value"] <= after["min_value"]


def test_range_divides_the_hot_key(hot, rows):
    laid = by_range(hot, 9, "k")
    assert max(r["record_count"] for r in partition_stats(laid, "k").collect()) < 2000
    assert rows(laid) == rows(hot)


def test_coalesce_never_adds_partitions(even):
    assert read_width(merged(even, 2)) == 2
    assert read_width(merged(even, 50)) == 3


def test_partition_stats_cover_all_rows(even):
    stats = partition_stats(even, "v").collect()
    assert [r["partition_number"] for r in stats] == [0, 1, 2]
    assert sum(r["record_count"] for r in stats) == 6000
    assert stats[0]["min_value"] == 0 and stats[2]["max_value"] == 5999


def test_rows_of_partition(even):
    stats = {r["partition_number"]: r["record_count"] for r in partition_stats(even, "v").collect()}
    assert rows_of_partition(even, 2).count() == stats[2]


def test_no_spread_without_hot_keys(even):
    assert hot_spread(even, "k", partitions=8) is None


def test_spread_table_is_bounded(hot):
    assert hot_spread(hot, "k", partitions=8).count() == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_copartitioned_join_keeps_rows_whole(spark, hot, rows, how):
    names = spark.range(0, 60).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    expected = hot.join(names, F.col("k") == F.col("key"), how)
    found = join_copartitioned(hot, names, "k", "key", 8, how)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


def test_copartitioned_join_matches_hot_to_hot(spark, hot, rows):
    other = hot.filter("v < 300").select(F.col("k").alias("key"), F.col("v").alias("w"))
    expected = hot.join(other, F.col("k") == F.col("key"))
    assert rows(join_copartitioned(hot, other, "k", "key", 8)) == rows(expected)


def test_salted_join_adds_no_shuffle(spark, hot, plan):
    few = spark.range(0, 60).select(F.col("id").alias("key"))
    for joined in (
        join_copartitioned(hot, few, "k", "key", 8),
        join_copartitioned(few, hot, "key", "k", 8),
        join_copartitioned(hot, hot.toDF("key", "w"), "k", "key", 8),
    ):
        text = plan(joined)
        assert text.count("Exchange hashpartitioning") == 2 and text.count("REPARTITION_BY_NUM") == 2


def test_copartitioned_join_spreads_a_hot_right_side(spark, hot, rows):
    few = spark.range(0, 60).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    joined = join_copartitioned(few, hot, "key", "k", 8)
    assert rows(joined) == rows(few.join(hot, F.col("key") == F.col("k")))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert largest_partition(join_copartitioned(few, hot, "key", "k", 8)) < 3000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_copartitioned_join_refuses_right_and_full(hot):
    with pytest.raises(ValueError):
        join_copartitioned(hot, hot.toDF("key", "w"), "k", "key", 8, "outer")


def test_pair_totals_equal_the_counted_pairs(even, hot, rows):
    left, right = even.filter("v < 500"), hot.filter("v < 500").toDF("key", "w")
    pairs = left.join(right, F.col("k") == F.col("key")).groupBy("k").count()
    found = pair_totals(left, right, "k", "key").select("join_key", F.col("pairs").cast("bigint"))
    assert rows(found) == rows(pairs)


def test_pair_totals_do_not_overflow(spark):
    counts = spark.createDataFrame([(1,)], "k INT")
    assert pair_totals(counts, counts, "k", "k").schema["pairs"].dataType.simpleString() == "decimal(38,0)"


def test_fits(even):
    assert fits(even, 10_000_000) and fits(even.limit(0), 0)
    assert not fits(even, 6000 * 30)  # more rows than the limit has room for
    assert not fits(even, 6000 * 40)  # room for the rows, not for what they hold


@pytest.fixture
def copies(spark):
    """A third of the rows are copies of one row, in several input partitions."""
    return spark.range(0, 9000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"),
    )


def largest_partition(df):
    return max(row["record_count"] for row in partition_stats(df, "k").collect())


def test_copies_of_one_row_are_divided(spark, copies, rows):
    for laid in (by_hash(copies, 8, "k"), by_range(copies, 8, "k")):
        assert largest_partition(laid) < 2500
        assert rows(laid) == rows(copies)


def test_sort_divides_copies_of_one_row(spark, copies):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        ordered = in_order(copies, "k")
        assert largest_partition(ordered) < 2500
        assert largest_partition(copies.orderBy("k")) >= 3000
        keys = [row.k for row in ordered.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert keys == sorted(keys) and len(keys) == 9000


def test_marks_are_the_same_when_a_task_runs_again(copies, rows):
    marked = copies.withColumn("mark", row_mark())
    assert rows(marked) == rows(marked)
    assert marked.select("mark").distinct().count() == 9000


def test_equal_rows_of_one_input_partition_are_spread(spark):
    same = spark.range(0, 20_000, numPartitions=2).select(F.lit(7).alias("k"))
    sizes = [row["record_count"] for row in partition_stats(by_hash(same, 8, "k"), "k").collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


HELPERS = ["row_mark", "salt", "buckets", "hot_hash", "left_salt", "right_copy", "_buckets", "_hot_hash", "_row_mark", "_salt"]


def test_columns_with_the_names_of_helpers_stay(spark, hot, rows):
    wide = hot.select("*", *(F.col("v").alias(name) for name in HELPERS))
    for laid in (by_hash(wide, 8, "k"), by_range(wide, 9, "k"), in_order(wide, "k")):
        assert laid.columns == wide.columns and rows(laid) == rows(wide)
    few = spark.range(0, 60).select(F.col("id").alias("key"))
    assert rows(join_copartitioned(wide, few, "k", "key", 8)) == rows(wide.join(few, F.col("k") == F.col("key")))


def test_hot_on_both_sides_copies_few_rows(spark):
    """A third of either side has one key: each side is copied by the root of the buckets, not by all of them."""
    one, other = (
        spark.range(0, 3000, numPartitions=3).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") + i).alias(name))
        for i, name in ((0, "k"), (10_000, "key"))
    )
    spreads = [hot_spread(df, *df.columns, partitions=400) for df in (one, other)]
    alone, both = spreads[0].first()["_buckets"], _rooted(*spreads).first()["_buckets"]
    assert alone > 200 and (both - 1) ** 2 < alone <= both**2
    assert join_copartitioned(one, other, "k", "key", 400).count() == 1_000_000
