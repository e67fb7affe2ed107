"""Column profile that merges by delivery (Q1, G3's sketch variant).

``quality.profile`` is exact and reads all history.  Here each delivery leaves
a small state, a row per column: exact row and value counts, an HLL sketch of
the distinct values, a KLL sketch of the numeric ones and a frequent-items
sketch.  All of them merge, so today's profile reads the states of the
deliveries (columns x deliveries rows of a few KB), not their rows, and a
delivery that comes again replaces its state.

Stated errors: distinct values 2 % (one standard error 0.8 %), quantiles 1.5 %
of rank, frequent values: every one that holds more than 1 % of a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 14                    # HLL of 2**14 registers
KLL_K = 400
TRACKED = 1000               # values that the frequent-items sketch tracks
DISTINCT_ERROR = 0.02
RANK_ERROR = 0.015
FREQUENT = 0.01


def profile_state(df: DataFrame, delivery: Column | str, columns: Sequence[str] | None = None,
                  numeric: Sequence[str] = ()) -> DataFrame:
    """One row per delivery and column.  ``numeric`` columns, also as text,
    get quantiles; what does not parse counts as a value all the same.  The
    values are unpivoted and aggregated before the shuffle, so what moves is a
    row per task, delivery and column."""
    columns = list(columns or df.columns)
    d = F.col(delivery) if isinstance(delivery, str) else delivery
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"),
                               (F.col(f"`{c}`").cast("string").try_cast("double") if c in numeric
                                else F.lit(None).cast("double")).alias("number")) for c in columns])
    long = df.select(d.cast("string").alias("_delivery"), F.inline(cells))
    return long.groupBy("_delivery", "column_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("value").alias("present"),
        F.hll_sketch_agg("value", LG_K).alias("hll"),
        F.kll_sketch_agg_double("number", KLL_K).alias("kll"), F.count("number").alias("numbers"),
        F.call_function("approx_top_k_accumulate", F.col("value"), F.lit(TRACKED)).alias("top"))


def fold(state: DataFrame, path: str) -> None:
    """Write, or replace, the state of the deliveries present in ``state``."""
    (state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_delivery").parquet(path))


def merged(spark: SparkSession, path: str, quantiles: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """The profile of all deliveries: column_name, row_count and null_count
    (exact), distinct_count (estimate), quantiles (of numeric columns) and
    frequent: (item, count) of the values that may hold over 1 %."""
    both = spark.read.parquet(path).groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("present").alias("present"), F.hll_union_agg("hll").alias("hll"),
        F.kll_merge_agg_double("kll").alias("kll"), F.sum("numbers").alias("numbers"),
        F.call_function("approx_top_k_combine", F.col("top"), F.lit(TRACKED)).alias("top"))
    top = F.call_function("approx_top_k_estimate", F.col("top"), F.lit(int(1 / FREQUENT)))
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    return both.select(
        "column_name", "row_count", (F.col("row_count") - F.col("present")).alias("null_count"),
        F.hll_sketch_estimate("hll").alias("distinct_count"),
        F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("kll", ranks)).alias("quantiles"),
        F.filter(top, lambda x: x["item"].isNotNull() & (x["count"] >= F.col("row_count") * FREQUENT)).alias("frequent"))
