"""Telling whole records from broken ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.files import CORRUPT_COLUMN, PLACE_COLUMN


def valid_records(parsed: DataFrame, corrupt: str = CORRUPT_COLUMN) -> DataFrame:
    """The records that parsed, without the column for broken text."""
    return parsed.filter(F.col(corrupt).isNull()).drop(corrupt)


def malformed_records(parsed: DataFrame, corrupt: str = CORRUPT_COLUMN) -> DataFrame:
    """The raw text of broken records."""
    return parsed.filter(F.col(corrupt).isNotNull()).select(corrupt)


def malformed_lines(parsed: DataFrame, corrupt: str = CORRUPT_COLUMN, place: str = PLACE_COLUMN) -> DataFrame:
    """The raw text of each broken line, once per line: equal lines stay, records of one array do not repeat it."""
    return malformed_records(parsed.filter(F.col(place) == 0), corrupt)
