"""Catalog tables over written folders.

The reference addresses every layer as a catalog table (``silver.policies``,
``gold.fact_policy``) and creates them with CREATE OR REPLACE TABLE ... AS
SELECT.  Without a transactional table format the Spark-native equivalent
is: write the DataFrame to its folder (overwrite), then (re)register an
*external* parquet table on that folder.  Dropping an external table never
deletes data.  Databases get an explicit location in the shared work
folder, never the machine-local default warehouse directory.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return f"`{name}`"


def ensure_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)} LOCATION '{location}'")


def register_table(spark: SparkSession, database: str, table: str, path: str) -> None:
    """(Re)point ``database.table`` at the parquet folder ``path``; a table
    of the same columns is repointed in place."""
    full = f"{_ident(database)}.{_ident(table)}"
    if spark.catalog.tableExists(f"{database}.{table}"):
        old, new = spark.table(full).schema, spark.read.parquet(path).schema
        if [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new]:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
            spark.catalog.refreshTable(f"{database}.{table}")
            return
        spark.sql(f"DROP TABLE {full}")
    spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")


def create_or_replace_table(spark: SparkSession, df: DataFrame, database: str,
                            table: str, path: str) -> DataFrame:
    """Write ``df`` to a new folder below ``path`` and point the table
    at it.  The earlier folder stays, so readers of it, and a ``df`` that
    reads this very table, are not disturbed."""
    fresh = f"{path}/version-{uuid.uuid4().hex[:12]}"
    df.write.parquet(fresh)
    register_table(spark, database, table, fresh)
    return spark.table(f"{_ident(database)}.{_ident(table)}")
