"""Name formatting and report lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def proper_name(name: Column | str) -> Column:
    """``"SMITH,JOHN"`` to ``"Smith, John"``, without a Python worker.

    Each comma part gets an upper-case first letter and lower case after it. Trailing
    commas and leading blanks go, other blanks and empty inner parts stay, null stays null.
    """
    column = F.col(name) if isinstance(name, str) else name
    parts = F.split(F.regexp_replace(column, ",+$", ""), ",")
    cased = F.transform(
        parts,
        lambda part: F.concat(
            F.upper(F.substring(part, 1, 1)),
            F.lower(part.substr(F.lit(2), F.length(part))),
        ),
    )
    return F.regexp_replace(F.array_join(cased, ", "), r"^[\x00-\x20]+", "")


def report_line(name_label: str, name: str, kind_label: str, kind: str) -> Column:
    """``<label>: <name padded to 35> | <label>: <kind>``; a longer name is kept whole."""
    return F.format_string(f"{name_label}: %-35s | {kind_label}: %s", F.col(name), F.col(kind))
