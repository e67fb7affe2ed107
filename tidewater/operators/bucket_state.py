"""Keyed state in hash buckets, of which a run rewrites only those it touches.

A state table is a folder ``run=<n>/bucket=<b>``.  A run writes the buckets
that it changes, whole, to a folder of its own; the current version of a
bucket is that of the last run which wrote it.  So

* a run costs what its buckets cost, not what the history costs;
* a run that failed is repeated: it reads what stood before it (``before``)
  and overwrites its own folder, so nothing is applied twice;
* readers never see half a run: a run counts from the moment that Spark's
  committer has written ``_SUCCESS`` into its folder, and no folder that a
  reader may hold is changed.

Rows of a touched bucket may be replaced but not all removed (an empty bucket
would leave no folder).  ``compact`` rewrites the current version as one run,
``vacuum`` deletes versions that no later run reads.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
PARTS = 16           # shares of a bucket in the tasks that write it


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


class BucketState:
    def __init__(self, spark: SparkSession, path: str, schema: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.buckets = spark, path.rstrip("/"), schema, buckets

    def bucket_of(self, *key: str) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def folder(self, run: int) -> str:
        return f"{self.path}/run={run}"

    def _children(self, path: str, name: str) -> list[int]:
        fs, target = _fs(self.spark, path)
        if not fs.exists(target):
            return []
        found = [re.fullmatch(rf"{name}=(\d+)", s.getPath().getName()) for s in fs.listStatus(target)]
        return sorted(int(m.group(1)) for m in found if m)

    def committed(self, run: int) -> bool:
        fs, target = _fs(self.spark, f"{self.folder(run)}/_SUCCESS")
        return fs.exists(target)

    def runs(self, before: int | None = None) -> list[int]:
        """Committed runs, ascending."""
        return [r for r in self._children(self.path, "run") if (before is None or r < before) and self.committed(r)]

    def touched(self, run: int) -> list[int]:
        """Buckets that a run wrote."""
        return self._children(self.folder(run), "bucket")

    def versions(self, before: int | None = None) -> dict[int, int]:
        """The run that holds the current version of each bucket."""
        out: dict[int, int] = {}
        for run in self.runs(before):
            out.update(dict.fromkeys(self.touched(run), run))
        return out

    def _load(self, paths: list[str]) -> DataFrame:
        schema = f"{self.schema}, run int, bucket int"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def read(self, buckets: Iterable[int] | None = None, before: int | None = None) -> DataFrame:
        """Current rows (of some buckets), with columns ``run`` and ``bucket``."""
        now = self.versions(before)
        wanted = sorted(now if buckets is None else set(buckets) & set(now))
        return self._load([f"{self.folder(now[b])}/bucket={b}" for b in wanted])

    def read_run(self, run: int) -> DataFrame:
        """What a run wrote."""
        return self._load([f"{self.folder(run)}/bucket={b}" for b in self.touched(run)])

    def deal(self, rows: DataFrame, *key: str) -> DataFrame:
        """The rows (with ``bucket``) dealt by bucket and a further share of the
        key, as ``part``: what is grouped by both and the key, then written
        with ``dealt``, moves once, and no task has a whole bucket of a large
        state."""
        return rows.withColumn("part", F.pmod(F.hash(*key), F.lit(PARTS))).repartition("bucket", "part")

    def write(self, rows: DataFrame, run: int, *spread: Column, dealt: bool = False) -> None:
        """The rows (with ``bucket``) as the version of a run.  Where keys are
        unique, a hash bucket holds its share and no more; where one key may
        hold many rows, ``spread`` deals a bucket's rows to several tasks and
        files (readers split files as usual).  ``dealt`` rows stay where they
        are."""
        names = [f.strip().split(" ")[0] for f in _fields(self.schema)]
        kept = rows.select(*names, "bucket", *[c.alias(f"_spread{i}") for i, c in enumerate(spread)])
        extra = [f"_spread{i}" for i in range(len(spread))]
        placed = kept if dealt else kept.repartition("bucket", *extra).drop(*extra)
        placed.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(self.folder(run))

    def compact(self, run: int) -> None:
        """The current version as one run, later than all others."""
        if any(r >= run for r in self.runs()):
            raise ValueError("the run that compacts must be the last one")
        self.write(self.read(), run)

    def vacuum(self) -> int:
        """Delete bucket versions that a later run has replaced; their number."""
        now, gone = self.versions(), 0
        for run in self.runs():
            for b in self.touched(run):
                if now[b] != run:
                    fs, target = _fs(self.spark, f"{self.folder(run)}/bucket={b}")
                    gone += bool(fs.delete(target, True))
        return gone


def _fields(schema: str) -> list[str]:
    """Top-level fields of a DDL string."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(schema[at:i])
            at = i + 1
    return [*out, schema[at:]]


def buckets_in(df: DataFrame) -> list[int]:
    """The buckets that occur: at most as many numbers as there are buckets."""
    return sorted(r[0] for r in df.select("bucket").distinct().collect())
