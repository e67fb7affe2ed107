"""Reading the tables and writing intermediate results of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package


def prepare(df: DataFrame) -> SparkSession:
    """The frame's session, with this package importable in its workers."""
    spark = df.sparkSession
    ship_package(spark)
    return spark


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: lineage ends
    at files that every executor can read again after a loss.

    ``batch_rows`` limits the rows that this one job hands to Python at a
    time, for rows that carry whole or cut-out texts: at the usual 10,000 a
    run of long ones would not fit an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(BATCH_ROWS)
    if batch_rows:
        spark.conf.set(BATCH_ROWS, batch_rows)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further ones can't clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])
