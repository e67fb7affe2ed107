"""Exact distinct counts kept up to date by delivery, as bitmaps.

COUNT(DISTINCT key) per group can't be added up over deliveries, and counting
again reads all history.  Here every key gets a dense number once, and a group
is the set of its keys' numbers as bitmaps of 32,768 bits, which merge by OR.

* Dictionary: keys live in hash buckets; new keys of a delivery are numbered
  on from the last number of their bucket, so nothing is sorted globally and
  numbers never change.  A bucket has its own range of numbers, so a bitmap
  belongs to one bucket, and a run rewrites the touched buckets only.
* Sets (``moving=False``): a key may be in several groups and stays in them;
  a delivery's bitmaps are ORed to those that stand there.
* Moving keys (``moving=True``): a key is in the one group that its latest
  version names; a later version takes it out of the group it was in.  The
  bitmaps of the touched buckets are made again from the dictionary.

Bitmaps pay where groups hold many keys each: one of 4 KB stands for up to
32,768 keys of a group and bucket.  Null keys are not counted; a null group is
a group.  A delivery that comes again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bucket_state import BUCKETS, BucketState, buckets_in

RANGE = 1 << 32              # numbers of a bucket; from 1 on


class DistinctState:
    def __init__(self, spark: SparkSession, path: str, moving: bool = False, buckets: int = BUCKETS):
        self.moving = moving
        self.keys = BucketState(spark, f"{path}/keys", "key string, n bigint, version string, grp string", buckets)
        self.bits = BucketState(spark, f"{path}/bits", "grp string, chunk bigint, bits binary", buckets)

    def fold(self, run: int, rows: DataFrame) -> None:
        """Fold a delivery: columns key, grp and, for moving keys, version
        (text, a later one wins).  A completed run is not repeated."""
        if self.bits.committed(run):
            return
        version = F.col("version") if self.moving else F.lit(None)
        given = (rows.where(F.col("key").isNotNull())
                 .select(F.col("key").cast("string").alias("key"), version.cast("string").alias("version"),
                         F.col("grp").cast("string").alias("grp"))
                 .withColumn("bucket", self.keys.bucket_of("key")).dropDuplicates())
        touched = buckets_in(given)
        old = self.keys.read(touched, before=run)
        tag = lambda df, n, new: df.select("bucket", "key", n.alias("n"), F.struct(
            "version", F.lit(new).alias("new"), "grp").alias("v"))
        # of equal versions the one that came last counts
        merged = (tag(old, F.col("n"), False).unionByName(tag(given, F.lit(None).cast("bigint"), True))
                  .groupBy("bucket", "key").agg(F.max("n").alias("n"), F.max("v").alias("v")))
        mine = Window.partitionBy("bucket")
        new_first = mine.orderBy(F.col("n").isNotNull(), "key")
        numbered = merged.withColumns({"_last": F.coalesce(F.max("n").over(mine), F.lit(0)),
                                       "_nth": F.row_number().over(new_first)})
        grp, when = ("v.grp", "v.version") if self.moving else (None, None)
        none = F.lit(None).cast("string")
        self.keys.write(numbered.select(
            "bucket", "key", F.coalesce("n", F.col("_last") + F.col("_nth")).alias("n"),
            (F.col(when) if when else none).alias("version"), (F.col(grp) if grp else none).alias("grp")), run)
        known = self.keys.read_run(run)
        number = F.col("bucket").cast("bigint") * RANGE + F.col("n")
        members = known.select("bucket", "grp", "n") if self.moving else (
            given.select("bucket", "key", "grp").join(known.select("bucket", "key", "n"), ["bucket", "key"]))
        fresh = (members.select("bucket", "grp", number.alias("n"))
                 .groupBy("bucket", "grp", F.bitmap_bucket_number("n").alias("chunk"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")))
        if not self.moving:
            stood = self.bits.read(touched, before=run).select("bucket", "grp", "chunk", "bits")
            fresh = (stood.unionByName(fresh).groupBy("bucket", "grp", "chunk")
                     .agg(F.bitmap_or_agg("bits").alias("bits")))
        self.bits.write(fresh, run)

    def counts(self, group: Column | None = None) -> DataFrame:
        """(grp, keys): distinct keys of every group, or of every value of
        ``group``, an expression over ``grp``: a key in several groups of one
        value counts once."""
        g = F.col("grp") if group is None else group
        return (self.bits.read().groupBy(g.alias("grp"), "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
                .groupBy("grp").agg(F.sum(F.bitmap_count("bits")).alias("keys")))
