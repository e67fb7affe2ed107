"""Audit counts taken by the job that writes (Q5).

``quality.audit`` and ``layers.audit_silver`` read each layer again to count
it.  ``DataFrame.observe`` counts rows and sums while they pass through the
write: no scan beyond the write's own.  The counts are kept as a table, one
row per run, layer and table.  Streams report theirs through a listener.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

AUDIT = "run string, layer string, table_name string, metric string, value decimal(38,4)"


class Counted:
    """Frames of one job whose rows are counted as they pass."""

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, stage: str, metrics: Mapping[str, Column] | None = None) -> DataFrame:
        """``df``, with rows (and further aggregates) counted under ``stage``."""
        o = Observation()
        self._seen.append((stage, o))
        exprs = {"rows": F.count(F.lit(1)), **(metrics or {})}
        return df.observe(o, *[c.alias(n) for n, c in exprs.items()])

    def values(self) -> dict[str, dict]:
        """stage -> metric -> value, after the job's action."""
        return {stage: dict(o.get) for stage, o in self._seen}


def write_counted(df: DataFrame, write: Callable[[DataFrame], None], counted: Counted,
                  stage: str = "rows_out", metrics: Mapping[str, Column] | None = None) -> dict[str, dict]:
    """Write ``df`` and return what was counted on the way."""
    write(counted.watch(df, stage, metrics))
    return counted.values()


def record(spark: SparkSession, path: str, run: str, layer: str, table: str, values: Mapping[str, float]) -> None:
    """Keep a run's counts, replacing those of the same run, layer and table."""
    rows = [(run, layer, table, k, str(v)) for k, v in values.items()]
    df = spark.createDataFrame(rows, "run string, layer string, table_name string, metric string, value string")
    (df.withColumn("value", F.col("value").cast("decimal(38,4)")).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run", "layer", "table_name").parquet(path))


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """run, layer, table_name, metric, value of all runs."""
    return spark.read.schema(AUDIT).parquet(path)


class StreamAudit(StreamingQueryListener):
    """Adds up the observed metrics of every stream by query, observation name and
    metric.  Counts are of committed micro-batches' processing; a batch that is
    replayed after a failure is reported again, under the same batch number,
    and replaces its first report."""

    def __init__(self) -> None:
        self._batches: dict[tuple[str, str, str, int], float] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in p.observedMetrics.items():
            for metric, value in row.asDict().items():
                self._batches[(str(p.id), name, metric, p.batchId)] = value or 0

    def totals(self, query_id: str) -> dict[str, dict]:
        out: dict[str, dict] = {}
        for (q, name, metric, _), value in self._batches.items():
            if q == query_id:
                out.setdefault(name, {})[metric] = out.get(name, {}).get(metric, 0) + value
        return out
