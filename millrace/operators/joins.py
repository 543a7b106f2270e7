"""Joins beyond a plain ``DataFrame.join``: checked broadcast, co-partitioning, pair totals."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.layout import fresh, hot_spread, with_buckets, with_salt

BROADCAST_LIMIT = 64 * 1024 * 1024

_ROW_OVERHEAD = 16
_FIELD_OVERHEAD = 8


def fits(df: DataFrame, limit: int) -> bool:
    """Whether the rows of ``df`` take at most ``limit`` bytes in memory.

    The number of rows, which a plain Parquet scan takes from file footers, rules out
    large inputs; only what remains is read to be measured.
    """
    fixed = _ROW_OVERHEAD + _FIELD_OVERHEAD * len(df.columns)
    if df.count() * fixed > limit:
        return False
    text = F.octet_length(F.to_json(F.struct("*")))
    size = df.select((text + fixed).cast("bigint").alias("size")).agg(F.sum("size").alias("size")).first()["size"]
    return (size or 0) <= limit


def join_broadcasting(
    large: DataFrame,
    small: DataFrame,
    on,
    how: str = "inner",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Broadcast ``small`` whatever Spark estimates, provided its measured size is within ``limit``.

    Above the limit the join is left to Spark, which shuffles both sides and splits
    skewed partitions.
    """
    return large.join(F.broadcast(small) if fits(small, limit) else small, on, how)


def join_copartitioned(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    partitions: int,
    how: str = "inner",
) -> DataFrame:
    """Join two inputs that are first hash-partitioned alike, so the join adds no shuffle.

    Spark does not split a partitioning the user asked for, so hot keys are spread here:
    the rows of a hot key take a salt, and its rows on the other side exist once per
    salt. That keeps results whole where each row of the salted side finds its partners
    by itself: on both sides of an inner join, on the left of the others. A key that is hot on
    both sides takes the square root of its buckets on each, so its pairs still fill that many
    buckets. Semi and anti joins see each key of ``right`` once. The keys must have different
    names. Finding hot keys takes one pass over each input when the join is built.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} join cannot repeat rows of the right side")
    if how in ("left_semi", "left_anti"):
        right = right.select(right_key).distinct()
    left_spread = hot_spread(left, left_key, partitions=partitions)
    right_spread = hot_spread(right, right_key, partitions=partitions) if how == "inner" else None
    if left_spread is not None and right_spread is not None:
        left_spread, right_spread = _rooted(left_spread, right_spread), _rooted(right_spread, left_spread)
    salts = {name: fresh(name, left, right) for name in ("left_salt", "left_copy", "right_salt", "right_copy")}
    left_columns, right_columns = [left_key], [right_key]
    if left_spread is not None:
        left = with_salt(left, left_spread, salts["left_salt"], left_key)
    if right_spread is not None:
        right = with_salt(right, right_spread, salts["right_salt"], right_key)
    if left_spread is not None:
        right = _copied(right, left_spread, right_key, salts["left_copy"])
        left_columns, right_columns = [*left_columns, salts["left_salt"]], [*right_columns, salts["left_copy"]]
    if right_spread is not None:
        left = _copied(left, right_spread, left_key, salts["right_copy"])
        left_columns, right_columns = [*left_columns, salts["right_copy"]], [*right_columns, salts["right_salt"]]
    same = reduce(and_, (F.col(one) == F.col(other) for one, other in zip(left_columns, right_columns)))
    joined = left.repartition(partitions, *left_columns).join(
        right.repartition(partitions, *right_columns), same, how
    )
    return joined.drop(*left_columns[1:], *right_columns[1:])


def _rooted(spread: DataFrame, other: DataFrame) -> DataFrame:
    """``spread`` with the square root of the buckets of keys that ``other`` has too."""
    both = spread.join(F.broadcast(other.select(F.col("_hot_hash").alias("hash"))), F.col("_hot_hash") == F.col("hash"), "left")
    root = F.ceil(F.sqrt("_buckets")).cast("int")
    return both.select("_hot_hash", F.when(F.col("hash").isNotNull(), root).otherwise(F.col("_buckets")).alias("_buckets"))


def _copied(df: DataFrame, spread: DataFrame, key: str, salt: str) -> DataFrame:
    """``df`` once per salt of the other side: several times for its hot keys, once for other rows."""
    buckets = fresh("buckets", df)
    copies = F.explode(F.sequence(F.lit(0), F.col(buckets) - 1))
    return with_buckets(df, spread, buckets, key).withColumn(salt, copies).drop(buckets)


def unmatched(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key never occurs in ``right``; a null key never matches.

    ``right`` is reduced to its distinct keys before the join, so a key that fills much
    of ``right`` reaches the join once.
    """
    keys = right.select(F.col(right_key).alias("right_key")).distinct()
    return left.join(keys, left[left_key] == keys["right_key"], "left_anti")


def matched(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``, each once."""
    keys = right.select(F.col(right_key).alias("right_key")).distinct()
    return left.join(keys, left[left_key] == keys["right_key"], "left_semi")


def pair_totals(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """How many row pairs a many-to-many join would give per key, without forming a pair.

    Each side is counted per key first; the count of pairs is the product.
    """
    left_counts = left.groupBy(F.col(left_key).alias("join_key")).agg(F.count("*").alias("left_rows"))
    right_counts = right.groupBy(F.col(right_key).alias("join_key")).agg(F.count("*").alias("right_rows"))
    wide = "decimal(19,0)"
    return left_counts.join(right_counts, "join_key").withColumn(
        "pairs", (F.col("left_rows").cast(wide) * F.col("right_rows").cast(wide)).cast("decimal(38,0)")
    )
