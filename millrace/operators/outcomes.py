"""What a step does when it must fail, as rows."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


def error_class(error: Exception) -> str | None:
    """The class by which Spark names an error, or the first cause that it names; None if there is none.

    Causes below that one say what went wrong with the record that failed first, which is another
    one from run to run.
    """
    found = error.getCondition() if isinstance(error, PySparkException) else None
    cause = error.java_exception if isinstance(error, Py4JJavaError) else None
    while found is None and cause is not None:
        found = cause.getCondition() if hasattr(cause, "getCondition") else None
        cause = cause.getCause()
    return found


def outcome(spark: SparkSession, label: str, step: Callable[[], int]) -> DataFrame:
    """``step, n_rows, error_class``: what ``step`` returns, or the class of the error that it raises.

    Only errors that Spark raises count; others are mistakes of the caller and are raised.
    """
    try:
        row = (label, step(), None)
    except (PySparkException, Py4JJavaError) as error:
        row = (label, None, error_class(error))
    return spark.createDataFrame([row], "step STRING, n_rows BIGINT, error_class STRING")
