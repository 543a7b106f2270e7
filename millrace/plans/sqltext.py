"""SQL fragments shared by the oracle texts: exact sums and half-up averages."""

from __future__ import annotations


def exact_sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def half_up_mean(column: str) -> str:
    """Average of a non-negative amount, from whole cents, rounded half up to two decimals."""
    cents = f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) * 100 AS HUGEINT)"
    return f"((2 * {cents} + COUNT({column})) // (2 * COUNT({column}))) / 100.0"


def largest(column: str) -> str:
    return f"ROUND(MAX({column}), 2)"
