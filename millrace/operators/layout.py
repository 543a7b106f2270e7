"""How rows are spread over partitions.

A key may hold a large share of all rows. Redistribution by such a key would put that
share into one task, so the operators below spread the rows of hot keys and leave all
other keys together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most items that Spark's sketch of frequent items can follow.
_MOST_TRACKED = 1_000_000


def fresh(name: str, *inputs: DataFrame) -> str:
    """``name``, made longer until no input has a column of that name."""
    taken = {column.lower() for df in inputs for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_width(df: DataFrame) -> int:
    """Number of partitions of a plan without shuffles, such as a scan; runs no job."""
    return df.rdd.getNumPartitions()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_spread(df: DataFrame, *keys: str, partitions: int) -> DataFrame | None:
    """Key values too large for one of ``partitions``, and over how many buckets to spread each.

    One pass with a sketch per task, whose size follows from ``partitions`` alone. The table has a
    row ``_hot_hash, _buckets`` per value that holds more than twice an average partition, so
    never more than ``partitions / 2`` rows; ``None`` means that no value does. It only steers
    how rows are spread, never which rows are kept.
    """
    share = 2 / partitions
    if share >= 1:
        return None
    wanted = math.ceil(1 / share)
    row = df.select(F.xxhash64(*keys).alias("key")).agg(
        F.call_function("approx_top_k", F.col("key"), F.lit(wanted), F.lit(min(8 * wanted, _MOST_TRACKED))).alias("top"),
        F.count("*").alias("rows"),
    ).first()
    hot = [
        (entry["item"], 2 * math.ceil(entry["count"] * partitions / row["rows"]))
        for entry in row["top"]
        if entry["count"] > share * row["rows"]
    ]
    if not hot:
        return None
    return df.sparkSession.createDataFrame(hot, "_hot_hash BIGINT, _buckets INT")


def with_buckets(df: DataFrame, spread: DataFrame, name: str, *keys: str) -> DataFrame:
    """``df`` with the number of buckets of each row's key in column ``name``, 1 for ordinary keys."""
    spread = spread.toDF(fresh("hot_hash", df), name)
    marked = df.join(F.broadcast(spread), F.xxhash64(*keys) == F.col(spread.columns[0]), "left")
    return marked.withColumn(name, F.coalesce(name, F.lit(1))).drop(spread.columns[0])


def row_mark() -> Column:
    """A number that tells rows apart, even copies of one row: the input partition and a counter in it.

    A task that runs again over the same rows gives the same numbers.
    """
    return F.monotonically_increasing_id()


def with_salt(df: DataFrame, spread: DataFrame, name: str, *keys: str) -> DataFrame:
    """``df`` with a salt below the number of buckets of its key in column ``name``."""
    mark, buckets = fresh("row_mark", df), fresh("buckets", df)
    marked = with_buckets(df.withColumn(mark, row_mark()), spread, buckets, *keys)
    return marked.withColumn(name, F.pmod(mark, buckets).cast("int")).drop(mark, buckets)


def round_robin(df: DataFrame, partitions: int) -> DataFrame:
    """Equal numbers of rows per partition, whatever the values are."""
    return df.repartition(partitions)


def by_hash(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Equal keys in one partition, except keys too large for one, whose rows are spread."""
    spread = hot_spread(df, *keys, partitions=partitions)
    if spread is None:
        return df.repartition(partitions, *keys)
    salt = fresh("salt", df)
    return with_salt(df, spread, salt, *keys).repartition(partitions, *keys, salt).drop(salt)


def by_range(df: DataFrame, partitions: int, key: str) -> DataFrame:
    """Contiguous, ordered key ranges; the rows of one large key may fill several of them."""
    mark = fresh("row_mark", df)
    return df.withColumn(mark, row_mark()).repartitionByRange(partitions, key, mark).drop(mark)


def in_order(df: DataFrame, *keys: Column | str) -> DataFrame:
    """A global sort in which the rows of one large key, even copies of one row, can be divided among tasks.

    A sort gives each task a range of its keys. Rows equal in all of them come in no
    particular order, so a further key is free to divide them. Where the caller knows columns
    that tell rows apart, sorting by those too does the same, and lets later filters reach the
    scan.
    """
    mark = fresh("row_mark", df)
    return df.withColumn(mark, row_mark()).orderBy(*keys, mark).drop(mark)


def merged(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions without a shuffle; never more than before."""
    return df.coalesce(partitions)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with the ``partition_number`` each row lies in, counted from 0."""
    return df.withColumn("partition_number", F.spark_partition_id())


def partition_stats(df: DataFrame, column: str) -> DataFrame:
    """Rows, lowest and highest ``column`` value of every non-empty partition."""
    return (
        numbered(df.select(F.col(column).alias("value")))
        .groupBy("partition_number")
        .agg(
            F.count("*").alias("record_count"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
        .orderBy("partition_number")
    )


def rows_of_partition(df: DataFrame, number: int) -> DataFrame:
    """The rows that lie in one physical partition."""
    return numbered(df).filter(F.col("partition_number") == number)
