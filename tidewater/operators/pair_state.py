"""Sums over the pairs of an M:N join, kept up to date by delivery.

The loss ratios and the claim frequency (K4, K5, K13) are sums over all pairs
of rows of two tables that share a key:

    sum over pairs of left.x  = sum over keys of  X * r      X, l: sum and rows of the left side
    sum over pairs of right.y = sum over keys of  Y * l      Y, r: of the right side

These are bilinear in the two sides, so a delivery that changes them by dX, dl,
dY, dr changes the first sum, key by key, by

    d(X * r) = dX * r + X * dr + dX * dr

and the second alike.  A row that a later delivery replaces is taken back by
its old values with a minus sign, which a sum of deliveries alone can't do.

State, all in hash buckets of which a run rewrites the touched ones only
(``bucket_state``): the current row of every id on either side, with what it
was before the run that wrote it, so that a run's signed changes are read from
its own files; sums per key (and group, on the left) of either side; and the
totals that each run added, a row per group.  A run is complete once its
totals are; repeating it, before or after that, gives the same state, and a
delivery that comes again under a new number changes nothing.

Rows without an id are not kept (they can't be superseded; quarantine them).
A null key joins nothing; its rows count in ``left_rows`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bucket_state import BUCKETS, BucketState, buckets_in

AMOUNT = "decimal(18,4)"
SUM = "decimal(26,4)"
COUNT = "decimal(12,0)"          # a sum times a count still fits 38 digits
TOTAL = "decimal(38,4)"
_ROW = f"struct<grp:string,k:string,amount:{AMOUNT}>"
ROWS = f"id string, version string, now {_ROW}, was {_ROW}, changed boolean"
TOTALS = f"grp string, left_over_pairs {TOTAL}, right_over_pairs {TOTAL}, pairs {TOTAL}, keys bigint, left_rows bigint"


class PairState:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path
        state = lambda name, schema: BucketState(spark, f"{path}/{name}", schema, buckets)
        self.rows = {side: state(f"{side}_rows", ROWS) for side in ("left", "right")}
        # s0 and n0: before the run that wrote the row
        self.sums = {side: state(f"{side}_sums", f"k string, grp string, s {SUM}, n {COUNT}, s0 {SUM}, n0 {COUNT}")
                     for side in ("left", "right")}
        self.runs = BucketState(spark, f"{path}/totals", TOTALS, 1)

    def fold(self, run: int, left: DataFrame | None = None, right: DataFrame | None = None) -> None:
        """Fold a delivery of either side or both: columns id, k (the join's
        key), amount, version (text, a later one replaces) and, on the left,
        grp.  ``run`` numbers ascend; a completed run is not repeated."""
        if self.runs.committed(run):
            return
        signed = {}
        for side, rows in (("left", left), ("right", right)):
            if rows is not None:
                self._replace(side, rows, run)
            signed[side] = self._signed(side, run if rows is not None else None)
        # the changed keys' buckets, on both sides
        both = signed["left"].unionByName(signed["right"])
        touched = buckets_in(both.select(self.sums["left"].bucket_of("k").alias("bucket")))
        merged = {}
        for side in ("left", "right"):
            state = self.sums[side]
            old = state.read(touched, before=run).select("k", "grp", "s", "n", *_zero("ds", "dn"))
            new = self._changes(signed[side]).select("k", "grp", *_zero("s", "n"), "ds", "dn")
            moved = state.deal(old.unionByName(new).withColumn("bucket", state.bucket_of("k")), "k")
            sums = moved.groupBy("bucket", "part", "k", "grp").agg(
                *[F.sum(c).cast(SUM if c in ("s", "ds") else COUNT).alias(c) for c in ("s", "n", "ds", "dn")])
            after = sums.select("k", "grp", (F.col("s") + F.col("ds")).cast(SUM).alias("s"),
                                (F.col("n") + F.col("dn")).cast(COUNT).alias("n"), "bucket",
                                F.col("s").alias("s0"), F.col("n").alias("n0"))
            # the totals come from what was written: computed once, and in agreement with it
            state.write(after, run, dealt=True)
            merged[side] = state.read_run(run)
        l, r = merged["left"], merged["right"].select(
            "k", *[F.col(c).alias(f"r_{c}") for c in ("s", "n", "s0", "n0")])
        j = l.join(r, "k", "left").fillna(0, ["r_s", "r_n", "r_s0", "r_n0"])
        d = lambda c: F.col(c) - F.col(f"{c}0")
        product = lambda x, dx, y, dy: _total(dx * y) + _total(x * dy) + _total(dx * dy)
        held = lambda n: (F.col(n) > 0).cast("bigint")
        totals = j.select(
            "grp",
            product(F.col("s0"), d("s"), F.col("r_n0"), d("r_n")).alias("left_over_pairs"),
            product(F.col("r_s0"), d("r_s"), F.col("n0"), d("n")).alias("right_over_pairs"),
            product(F.col("n0"), d("n"), F.col("r_n0"), d("r_n")).alias("pairs"),
            F.when(F.col("k").isNotNull(), held("n") - held("n0")).otherwise(0).alias("keys"),
            d("n").cast("bigint").alias("left_rows"))
        out = totals.groupBy("grp").agg(*[F.sum(c).alias(c) for c in totals.columns[1:]])
        # a run without a change still writes a row, so that it counts as done
        none = self.spark.createDataFrame([(None, 0, 0, 0)], "grp string, pairs int, keys bigint, left_rows bigint")
        out = out.unionByName(none, allowMissingColumns=True).fillna(0)
        self.runs.write(out.select("grp", *[_total(F.col(c)).alias(c) for c in ("left_over_pairs", "right_over_pairs", "pairs")],
                                   "keys", "left_rows", F.lit(0).alias("bucket")), run)

    def _replace(self, side: str, rows: DataFrame, run: int) -> None:
        """Write the buckets of the delivered ids with their rows replaced
        where the delivery is as late as what stands there, or later."""
        state = self.rows[side]
        grp = F.col("grp") if "grp" in rows.columns else F.lit(None)
        given = rows.where(F.col("id").isNotNull()).select(
            F.col("id").cast("string").alias("id"), F.col("version").cast("string").alias("version"),
            F.struct(grp.cast("string").alias("grp"), F.col("k").cast("string").alias("k"),
                     F.col("amount").cast(AMOUNT).alias("amount")).alias("row")).withColumn("bucket", state.bucket_of("id"))
        touched = buckets_in(given)
        old = state.read(touched, before=run).select("id", "version", F.col("now").alias("row"), "bucket")
        # one row an id before it moves: the latest that came, and the one that stands
        tag = lambda df, new: df.select("bucket", "id", F.lit(new).alias("new"), "v")
        v = F.struct("version", "row").alias("v")
        came = given.groupBy("bucket", "id").agg(F.max(v).alias("v"))
        both = tag(old.select("bucket", "id", v), False).unionByName(tag(came, True))
        one = (state.deal(both, "id").groupBy("bucket", "part", "id")
               .agg(F.max(F.when(~F.col("new"), F.col("v"))).alias("old"), F.max(F.when(F.col("new"), F.col("v"))).alias("new")))
        takes = F.col("new").isNotNull() & (F.col("old").isNull() | (
            F.coalesce(F.col("new.version") >= F.col("old.version"), F.col("old.version").isNull())))
        pick = F.when(takes, F.col("new")).otherwise(F.col("old"))
        state.write(one.select("bucket", "id", pick["version"].alias("version"), pick["row"].alias("now"),
                               F.col("old.row").alias("was"),
                               (takes & ~F.col("new.row").eqNullSafe(F.col("old.row"))).alias("changed")), run, dealt=True)

    def _signed(self, side: str, run: int | None) -> DataFrame:
        """k, grp, amount, sign: the rows that a run took back and put in."""
        if run is None:
            return self.spark.createDataFrame([], f"k string, grp string, amount {AMOUNT}, sign int")
        changed = self.rows[side].read_run(run).where("changed")
        signed = changed.select(F.inline(F.array(F.struct(F.lit(-1).alias("sign"), F.col("was").alias("r")),
                                                 F.struct(F.lit(1).alias("sign"), F.col("now").alias("r")))))
        return signed.where(F.col("r").isNotNull()).select("r.k", "r.grp", "r.amount", "sign")

    def _changes(self, signed: DataFrame) -> DataFrame:
        """k, grp, ds, dn: the signed changes of a run, a row per key and group."""
        return (signed.groupBy("k", "grp").agg(F.sum(F.col("amount") * F.col("sign")).cast(SUM).alias("ds"),
                                               F.sum("sign").cast(COUNT).alias("dn")).fillna(0, ["ds"]))

    def totals(self) -> DataFrame:
        """grp, left_over_pairs, right_over_pairs, pairs, keys (with a row on
        the left) and left_rows of every group that has rows on the left."""
        t = self.spark.read.schema(f"{TOTALS}, run int, bucket int").option("basePath", self.runs.path).parquet(
            *[self.runs.folder(r) for r in self.runs.runs()])
        return t.groupBy("grp").agg(*[F.sum(c).alias(c) for c in ("left_over_pairs", "right_over_pairs", "pairs", "keys",
                                                                  "left_rows")]).where("left_rows > 0")


def _zero(*names: str) -> list[Column]:
    return [F.lit(0).cast(SUM if n in ("s", "ds") else COUNT).alias(n) for n in names]


def _total(c: Column) -> Column:
    return c.cast(TOTAL)
