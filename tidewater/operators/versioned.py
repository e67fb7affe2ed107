"""Tables replaced as a whole that readers survive (B2).

An overwrite in place deletes a table before it is written: a reader meets
nothing, or half of it, and a failed run leaves nothing.  Here each write goes
to a folder ``version=<n>`` of its own; the current version is the last one
that Spark's committer has finished.  Readers of an earlier one keep their
files until ``vacuum``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .bucket_state import _fs


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions, ascending."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    found = [(re.fullmatch(r"version=(\d+)", s.getPath().getName()), s.getPath()) for s in fs.listStatus(target)]
    done = [int(m.group(1)) for m, p in found if m and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(done)


def replace(df: DataFrame, path: str) -> str:
    """Write ``df`` as the next version; its folder.  A frame that reads the
    version before is not disturbed.  One writer at a time."""
    done = versions(df.sparkSession, path)
    folder = f"{path}/version={done[-1] + 1 if done else 1}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return folder


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table as last finished."""
    done = versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no finished version at {path}")
    return spark.read.parquet(f"{path}/version={done[-1]}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` finished versions; how many went."""
    old = versions(spark, path)[:-keep] if keep else versions(spark, path)
    for v in old:
        fs, target = _fs(spark, f"{path}/version={v}")
        fs.delete(target, True)
    return len(old)
