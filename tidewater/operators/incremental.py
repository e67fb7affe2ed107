"""Incremental KPI state.

A full refresh recomputes a KPI over all history every day.  Instead each
delivery's rows are folded into a small *state*: per KPI group and
delivery, the row count and, per measure, the exact sum and non-NULL count
(so AVG stays exact as sum / count).  States are written per delivery with
partition overwrite -- re-running a delivery replaces its state, never
doubles it -- and the KPI is a re-aggregation of the state, whose size is
groups x deliveries, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def partial_state(delta: DataFrame, keys: Sequence[str], measures: Sequence[str],
                  delivery: Column | str) -> DataFrame:
    """One delivery's contribution: (delivery, keys..., rows, sum/count per measure)."""
    d = F.col(delivery) if isinstance(delivery, str) else delivery
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for m in measures:
        aggs += [F.sum(m).alias(f"_sum_{m}"), F.count(m).alias(f"_cnt_{m}")]
    return delta.groupBy(d.alias("_delivery"), *keys).agg(*aggs)


def fold(state: DataFrame, path: str) -> None:
    """Write/replace the state of the deliveries present in ``state``."""
    (state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_delivery").parquet(path))


def read_totals(spark: SparkSession, path: str, keys: Sequence[str],
                measures: Sequence[str]) -> DataFrame:
    """Merge all deliveries' states: rows, exact sums, non-NULL counts."""
    s = spark.read.parquet(path)
    aggs = [F.sum("_rows").alias("rows")]
    for m in measures:
        aggs += [F.sum(f"_sum_{m}").alias(f"sum_{m}"), F.sum(f"_cnt_{m}").alias(f"count_{m}")]
    return (s.groupBy(*keys) if keys else s).agg(*aggs)
