"""Money and labels as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# The labels and limits of the two reports.
HIGH_VALUE, MEDIUM_VALUE = 500, 100
FAST_LIMIT, NORMAL_LIMIT = 3, 10

#: Decimals of the amounts of money in the reports.
CENTS = 2

_HALF = float(2**20)


def total_type(scale: int) -> str:
    """Wide enough for any total, and a width that databases can store."""
    return f"decimal(28,{scale})"


def exact_total(df: DataFrame, amount: str, scale: int) -> Column:
    """Sum of an amount that has ``scale`` decimals, as an exact number that does not depend on row order.

    Doubles are summed as whole units of the last decimal, several times faster than as
    decimals, in two parts so that no long overflows. A total beyond the type is null, as is one
    of amounts with NaN or infinity. Amounts with more decimals are rounded to ``scale``: for
    those use a plain sum.
    """
    column = F.col(amount)
    if not isinstance(df.schema[amount].dataType, (DoubleType, FloatType)):
        return F.sum(column).cast(total_type(scale))
    odd = F.isnan(column) | (F.abs(column) == float("inf"))
    units = F.rint(F.when(~odd, column) * 10.0**scale)
    high = F.floor(units / _HALF)
    # Both parts are whole, and exact: a power of two only moves the exponent.
    low = (units - F.floor(units / _HALF).cast("double") * _HALF).cast("bigint")
    whole = F.try_sum(high).cast("decimal(20,0)") * F.lit(int(_HALF)) + F.try_sum(low).cast("decimal(20,0)")
    exact = (whole * F.lit(Decimal(1).scaleb(-scale))).try_cast(total_type(scale))
    return F.when(F.coalesce(F.bool_or(odd), F.lit(False)), None).otherwise(exact)


def total(df: DataFrame, amount: str, scale: int | None = None) -> Column:
    """A plain sum, or an exact one of amounts that have ``scale`` decimals."""
    return F.sum(amount) if scale is None else exact_total(df, amount, scale)


def mean(amount: Column, count: Column) -> Column:
    """Half-up average with two decimals from an exact total and a count."""
    return F.round(amount / count, 2).cast("decimal(18,2)")


def value_tier(amount: Column | str, high: float = HIGH_VALUE, medium: float = MEDIUM_VALUE) -> Column:
    """``High``, ``Medium`` or ``Low``; the limits belong to the upper tier, null is ``Low``."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.when(column >= high, "High").when(column >= medium, "Medium").otherwise("Low")


def response_speed(delay: Column | str, fast: float = FAST_LIMIT, normal: float = NORMAL_LIMIT) -> Column:
    """``Fast``, ``Normal`` or ``Slow``; the limits belong to the faster label, null is ``Slow``."""
    column = F.col(delay) if isinstance(delay, str) else delay
    return F.when(column <= fast, "Fast").when(column <= normal, "Normal").otherwise("Slow")
