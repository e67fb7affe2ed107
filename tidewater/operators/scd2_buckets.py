"""A versioned dimension of which a merge rewrites the touched buckets only.

``scd2.apply_snapshot`` reads and writes the whole dimension for each day.
Here it is kept in hash buckets of its business key (``bucket_state``): a
snapshot is first compared with the current rows, and only buckets with a new
or changed key are merged (by ``apply_snapshot`` itself) and written.  Each
merge leaves a change feed, a row per new or changed key with its surrogate
keys before and after, by which fact tables re-key only the facts of those
keys (``rekey``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scd2
from .bucket_state import BUCKETS, BucketState, buckets_in


class BucketDimension:
    def __init__(self, spark: SparkSession, path: str, key: str, attrs: Sequence[str], key_name: str,
                 key_type: str = "bigint", buckets: int = BUCKETS):
        self.key, self.attrs, self.key_name = key, list(attrs), key_name
        columns = ", ".join(f"{a} string" for a in attrs)
        self.rows = BucketState(spark, f"{path}/rows", f"{key_name} bigint, {key} {key_type}, {columns}, "
                                "EffectiveFrom date, EffectiveTo date, IsCurrent boolean", buckets)
        self.changes = BucketState(spark, f"{path}/changes", f"{key} {key_type}, old_key bigint, new_key bigint, since date",
                                   buckets)
        self.delivered = BucketState(spark, f"{path}/delivered", f"{key} {key_type}, {columns}, since date, old_key bigint",
                                     buckets)

    def merge(self, run: int, rows: DataFrame, snapshot: str, order: Sequence[Column] = ()) -> None:
        """Merge one snapshot (whole, or of some keys) under an ascending run
        number.  A completed run is not repeated."""
        if self.changes.committed(run):
            return
        key = self.key
        new = scd2._one_per_snapshot(rows, key, snapshot, order).select(
            key, *self.attrs, F.col(snapshot).cast("date").alias("since")).withColumn("bucket", self.rows.bucket_of(key))
        now = (self.rows.read(buckets_in(new), before=run).where("IsCurrent")
               .select(F.col(key).alias("_key"), F.col(self.key_name).alias("old_key"),
                       *[F.col(a).alias(f"_{a}") for a in self.attrs]))
        same = F.col("old_key").isNotNull()
        for a in self.attrs:
            same = same & F.col(a).eqNullSafe(F.col(f"_{a}"))
        # what changes, kept: it decides the buckets and is merged into them
        self.delivered.write(new.join(now, new[key] == now["_key"], "left").where(~same), run)
        changed = self.delivered.read_run(run)
        merged = scd2.apply_snapshot(self.rows.read(self.delivered.touched(run), before=run), changed, key, self.attrs,
                                     "since", self.key_name)
        self.rows.write(merged.withColumn("bucket", self.rows.bucket_of(key)), run)
        current = self.rows.read_run(run).where("IsCurrent").select(F.col(key).alias("_key"), F.col(self.key_name).alias("new_key"))
        feed = changed.join(current, changed[key] == current["_key"])
        self.changes.write(feed.withColumn("bucket", self.changes.bucket_of(key)), run)

    def read(self) -> DataFrame:
        return self.rows.read().drop("run", "bucket")


def rekey(facts: BucketState, feed: DataFrame, run: int, key: str, key_name: str, new_facts: DataFrame | None = None,
          spread: Sequence[Column] = ()) -> None:
    """Write the buckets of ``facts`` (in buckets of the dimension's business
    key) that the feed of a run, or new facts, touch: facts of changed keys
    get their new surrogate key, others stay as they are."""
    if facts.committed(run):
        return
    feed = feed.select(F.col(key).alias("_key"), "new_key")
    touched = set(buckets_in(feed.select(facts.bucket_of("_key").alias("bucket"))))
    if new_facts is not None:
        new_facts = new_facts.withColumn("bucket", facts.bucket_of(key))
        touched |= set(buckets_in(new_facts))
    old = facts.read(touched, before=run).drop("run")
    j = old.join(feed, old[key] == feed["_key"], "left")
    out = j.withColumn(key_name, F.coalesce("new_key", key_name)).drop("_key", "new_key")
    if new_facts is not None:
        out = out.unionByName(new_facts.select(*out.columns))
    facts.write(out, run, *spread)
