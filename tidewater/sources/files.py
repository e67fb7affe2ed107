"""File sources: CSV, multi-line JSON, parquet, workbooks, dispatched by
extension (A1-A8).

Readers take a *list* of deliveries (files or folders of part files) and give
every column that the files have, found by name and as text or as stored; the
declared types are applied afterwards (``quality.harmonize``), so a feed with
reordered, renamed or new columns lands in the right ones, and a phone
``020111`` is never read as a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .json_split import read_json_lines
from .workbooks import read_xlsx


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a CSV delivery (Spark reads the first line only)."""
    return tuple(spark.read.option("header", True).csv(path).columns)


def read_csv(spark: SparkSession, paths: Sequence[str], header: Sequence[str] | None = None) -> DataFrame:
    """A1: CSV deliveries of one header, as text.  A part file whose header
    differs from its delivery's is an error, not shifted columns."""
    names = header or csv_header(spark, paths[0])
    return (spark.read.option("header", True).option("enforceSchema", False)
            .schema(", ".join(f"`{n}` string" for n in names)).csv(list(paths)))


def read_json(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A3: files of JSON records -- an array of them, one, or several one after
    another -- of any size, read in splits (``json_split``), with the file of
    each record as ``_source_path``.  Spark's own multi-line reader takes a file
    in one task, and reads again from the file for every value that is no text."""
    return read_json_lines(spark, paths)


def read_parquet(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A4 (+ B1 read side): parquet; ``mergeSchema`` unions evolved schemas."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


READERS = {"csv": read_csv, "json": read_json, "parquet": read_parquet, "xlsx": read_xlsx}


def source_path(df: DataFrame):
    """Column with each row's file."""
    return F.col("_source_path") if "_source_path" in df.columns else F.col("_metadata.file_path")
