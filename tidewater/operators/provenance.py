"""Provenance stamps and the bronze append.

Stamp names: ``_src_country`` (not ``country``: Spark column names are
case-insensitive, and a feed with its own ``Country`` column would be
overwritten), ``SnapshotDate`` (yyyy-MM-dd text, as the reference writes
it) and ``FileName``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

META_COLS = ("_src_country", "SnapshotDate", "FileName")
DELIVERY = META_COLS          # a delivery is one file name of one country and day
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def snapshot_from_name(name: Column | str, default: str | None = None) -> Column:
    """Snapshot date taken from a ``yyyy-MM-dd`` in the file name, else
    ``default`` (the run date parameter, D12).  A name without a date and no
    run date is an error: such rows could never be ordered or re-run."""
    c = F.col(name) if isinstance(name, str) else name
    found = F.regexp_extract(c, DATE_IN_NAME, 1)
    undated = F.lit(default) if default is not None else F.raise_error(
        F.concat(F.lit("no date in the name and no run date: "), c)).cast("string")
    return F.when(found != "", found).otherwise(undated)


def stamp(df: DataFrame, country: Column | str, snapshot: Column | str,
          file_name: Column | str) -> DataFrame:
    """I5 + I6: add the three stamps and put them last."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    stamped = df.withColumns({
        "_src_country": as_col(country),
        "SnapshotDate": as_col(snapshot),
        "FileName": as_col(file_name),
    })
    data = [c for c in stamped.columns if c not in META_COLS]
    return stamped.select(*[F.col(f"`{c}`") for c in data], *META_COLS)


def append_partitioned(df: DataFrame, path: str,
                       partition_by: Sequence[str] = DELIVERY) -> None:
    """B1: write the rows under ``path`` partitioned by delivery.

    Dynamic partition overwrite replaces only the deliveries present in
    ``df``: re-running one replaces it instead of appending a duplicate
    (idempotent); other countries, days and deliveries stay.  Files written with a newer
    schema sit next to older ones; ``read_history`` merges them."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "zstd").partitionBy(*partition_by).parquet(path))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """B1 read side / W4: all deliveries, schemas merged (new columns NULL
    in older files).  The stamps come back as text, whatever their partition
    folders look like."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df.withColumns({c: F.col(c).cast("string") for c in META_COLS if c in df.columns})
