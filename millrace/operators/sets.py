"""Set operations on rows; duplicates are removed before rows are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(right).distinct()


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both inputs, once each; null equals null."""
    return _where(left, right, in_right=True)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not in ``right``, once each; null equals null."""
    return _where(left, right, in_right=False)


def _where(left: DataFrame, right: DataFrame, in_right: bool) -> DataFrame:
    """Rows of ``left`` that ``right`` has, or has not: both inputs grouped together.

    This is one shuffle of rows already reduced to distinct ones. ``intersect`` and
    ``subtract`` join on null-safe keys, which cost a second shuffle of each side. Rows go by
    position while they are grouped, so no column name can meet the flag's.
    """
    places = [f"c{i}" for i in range(len(left.columns))]
    flag = f"c{len(places)}"
    both = left.toDF(*places).withColumn(flag, F.lit(True)).union(right.toDF(*places).withColumn(flag, F.lit(False)))
    kept = both.groupBy(*places).agg(F.bool_or(flag).alias("here"), F.bool_or(~F.col(flag)).alias("there"))
    return kept.filter(F.col("here") & (F.col("there") == in_right)).select(*places).toDF(*left.columns)
