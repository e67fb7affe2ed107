"""Binary files written and read by Spark on any file system it reaches.

Spark's text sink writes the bytes of a string column unchanged, each row
followed by a separator, so a column of binary frames becomes a plain binary
file, at the place (local, HDFS, object store) that Spark is given, committed
task by task like any other output.  A row's frame plus the separator byte is
what the file holds; formats account for that byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_frames(frames: DataFrame, column: str, path: str, separator: str, per_file: int | None = None) -> None:
    """One file (or several of ``per_file`` frames) per partition of
    ``frames``, in partition order by name."""
    writer = frames.select(F.col(column).cast("string").alias("value")).write.option("lineSep", separator)
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.text(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the files; content is read only where used."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
            .load(path).select("path", "length", "content"))
