"""The named Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """``Tables(spark, folder).orders`` is a lazy scan of ``folder/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        scan = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        # Kept as an attribute, so the files are listed once.
        setattr(self, name, scan)
        return scan

    def on(self, spark: SparkSession) -> Tables:
        """The same tables read through another session."""
        return Tables(spark, self.folder)

    def register_views(self, *names: str) -> None:
        """Name the tables for ``spark.sql``; a view is a name for a plan, nothing is stored."""
        for name in names or TABLE_NAMES:
            getattr(self, name).createOrReplaceTempView(name)
