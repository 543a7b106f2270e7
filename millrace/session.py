"""Sessions, scoped settings and shared scratch folders."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_MASTER = re.compile(r"local(\[[^\]]*\])?$")


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scoped_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A sibling session with the caller's SQL settings plus ``settings``.

    Plans are lazy, so setting a value and putting it back before the action has no
    effect. A sibling session keeps the value for as long as its DataFrames live and
    leaves the caller's session alone.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    for key, value in settings.items():
        sibling.conf.set(key, value)
    return sibling


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors are one process on one machine."""
    return bool(_LOCAL_MASTER.match(spark.sparkContext.master))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name every executor can reach, below ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder. The
    folder is removed when the application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/millrace-{uuid.uuid4().hex}/{label}"
    _delete_at_exit(spark, path.rsplit("/", 1)[0])
    return path


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
