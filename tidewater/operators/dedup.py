"""Latest-row-per-key (the silver policy deduplication, W1).

``row_number() over (partition by key order by ... desc) = 1``.  Spark 3.5+
plans this as Sort -> WindowGroupLimit(partial) -> Exchange -> Sort ->
WindowGroupLimit(final): each map task keeps only its best row per key
before the shuffle, so a key holding a third of all rows ships at most one
row per input partition.  That is the pre-aggregation hot keys need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_fingerprint(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """Deterministic hash of all columns: the last-resort tie-break."""
    cols = [F.col(c) for c in df.columns if c not in set(exclude)]
    return F.xxhash64(*cols)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tiebreak: bool = True) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` (give desc columns).

    ``order`` should put NULLs last (``desc_nulls_last``) so a row without a
    date is never preferred.  With ``tiebreak`` a hash of the whole row is
    appended, which makes the winner independent of input order.
    """
    order = list(order)
    if tiebreak:
        order.append(row_fingerprint(df).desc())
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))
