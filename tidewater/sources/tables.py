"""Read the driver's parquet tables.

Every read is a plain ``spark.read.parquet`` so Catalyst prunes columns and
pushes filters into the scan; callers select only what they use.

Resolving a parquet relation (listing files, reading a footer for the
schema) happens on the driver each time ``spark.read`` is called, so the
DataFrame of each table is kept per session and reused: a view that reads
``orders`` twice resolves it once.  DataFrames are immutable, and Spark
de-duplicates the attributes when one is joined with itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

_RESOLVED: dict[tuple[int, str, str], DataFrame] = {}


class Tables:
    """Lazy accessor: ``Tables(spark, root).orders`` is a parquet DataFrame."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise KeyError(name)
        key = (id(self.spark), self.root, name)
        df = _RESOLVED.get(key)
        if df is None or df.sparkSession is not self.spark:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
            _RESOLVED[key] = df
        return df

    @staticmethod
    def refresh() -> None:
        """Forget resolved tables (call after new files land in a table)."""
        _RESOLVED.clear()

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)
