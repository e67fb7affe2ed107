"""Records of unknown or changing shape as VARIANT columns.

A JSON feed whose fields come and go, or change from a number to an object,
fits no declared column: as text it can't be queried, as a merged struct the
delivery that changed a type fails.  Here the whole record is one VARIANT: it is
appended like any bronze table (by delivery, idempotent), its shape over history
is an aggregate, and fields are read by path, each as the type that is asked
for, where the record has it so.  What does not parse as JSON is kept as text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .provenance import META_COLS, append_partitioned, stamp


def append_records(records: DataFrame, path: str, country: Column | str, snapshot: Column | str,
                   file_name: Column | str) -> None:
    """Append record texts (column ``value``) with provenance stamps: column
    ``record``, or ``unparsed`` where the text is no JSON.  A delivery that
    comes again replaces itself."""
    parsed = F.try_parse_json("value")
    rows = records.select(parsed.alias("record"), F.when(parsed.isNull(), F.col("value")).alias("unparsed"))
    append_partitioned(stamp(rows, country, snapshot, file_name), path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All deliveries."""
    df = spark.read.parquet(path)
    return df.withColumns({c: F.col(c).cast("string") for c in META_COLS})


def shapes(rows: DataFrame, *by: str) -> DataFrame:
    """The merged shape of the records, as a DDL string per group (``by``): a
    field of several types is itself a VARIANT in it."""
    return rows.groupBy(*by).agg(F.call_function("schema_of_variant_agg", F.col("record")).alias("shape"))


def fields(rows: DataFrame, paths: Mapping[str, tuple[str, str]], *keep: str) -> DataFrame:
    """Columns ``name -> (path, type)`` of the records; null where a record has
    no such field, or has it of another shape."""
    return rows.select(*keep, *[F.try_variant_get("record", path, kind).alias(name) for name, (path, kind) in paths.items()])
