"""The name formatting as a user-defined function.

``proper_name`` is the form to use; a Python function is opaque to the optimiser. The
function below works on Arrow batches, and is nested so that it is shipped by value and
executors need no copy of this package.
"""

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def proper_name_udf():
    """A vectorised function object with the rules of ``proper_name``."""

    def cased(name: str) -> str:
        parts = name.rstrip(",").split(",")
        joined = ", ".join(part[:1].upper() + part[1:].lower() for part in parts)
        return joined.lstrip("".join(map(chr, range(33))))

    def apply(names: pd.Series) -> pd.Series:
        return names.map(cased, na_action="ignore")

    return F.pandas_udf(apply, "string")


def register_proper_name(spark: SparkSession, name: str = "proper_name") -> str:
    """Make the function callable by name from SQL and from ``F.call_udf``."""
    spark.udf.register(name, proper_name_udf())
    return name
