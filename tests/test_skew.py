"""One key holding a third of all rows: results stay whole and exact."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.operators import scd2
from tidewater.operators.dedup import latest_per_key
from tidewater.plans import kpis

N = 30_000


def _hot(spark, n=N):
    # key 0 holds a third of the rows, the rest spread over 1,000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id"))


def test_dedup_hot_key(spark):
    df = _hot(spark)
    out = latest_per_key(df, ["k"], [F.col("id").desc()]).collect()
    got = {r["k"]: r["id"] for r in out}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("id").alias("m")).collect()}
    assert got == want


def test_pair_sums_hot_key(spark):
    base = _hot(spark, 6_000)
    fc = base.select(F.col("id").alias("ClaimID"), F.col("k").alias("CustomerKey"),
                     F.lit(None).cast("bigint").alias("VehicleKey"),
                     (F.col("id") % 7).cast("decimal(24,4)").alias("SettledAmount_INR"))
    fp = base.where(F.col("id") % 2 == 0).select(
        F.col("k").alias("CustomerKey"), F.lit(None).cast("bigint").alias("VehicleKey"),
        F.col("id").alias("PolicyNumber"), F.lit("T").alias("PolicyType"),
        (F.col("id") % 11 + 1).cast("decimal(18,2)").alias("AnnualPremium_INR"))
    got = kpis.loss_ratio_overall_as_written(fc, fp).first()["LossRatio"]
    # per-key totals computed separately; the fan-out sums follow from them
    c = {r[0]: (r[1], r[2]) for r in fc.groupBy("CustomerKey").agg(
        F.sum("SettledAmount_INR"), F.count(F.lit(1))).collect()}
    p = {r[0]: (r[1], r[2]) for r in fp.groupBy("CustomerKey").agg(
        F.sum("AnnualPremium_INR"), F.count(F.lit(1))).collect()}
    num = sum(c[k][0] * p[k][1] for k in c if k in p)
    den = sum(p[k][0] * c[k][1] for k in c if k in p)
    assert abs(got - float(num) / float(den)) < 1e-12


def test_point_in_time_hot_key(spark):
    d0 = dt.date(2024, 1, 1)
    versions = [(0, "A", d0), (0, "B", dt.date(2024, 3, 1)), (0, "C", dt.date(2024, 6, 1))]
    dim = scd2.build(spark.createDataFrame(versions, "CustomerID long, City string, SnapshotDate date"),
                     "CustomerID", ["City"], "SnapshotDate", "CustomerKey")
    facts = _hot(spark).where(F.col("k") == 0).select(
        "id", F.col("k").alias("CustomerID"),
        F.date_add(F.lit(d0), (F.col("id") % 300).cast("int")).alias("At"))
    j = scd2.as_of_join(facts, dim, "CustomerID", "CustomerID", "At")
    got = j.groupBy("_d.City").count().collect()
    want = (facts.select(F.when(F.col("At") < "2024-03-01", "A")
                          .when(F.col("At") < "2024-06-01", "B").otherwise("C").alias("City"))
            .groupBy("City").count().collect())
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert j.count() == facts.count()   # every fact exactly once


def test_hot_join_key_is_split(spark):
    """The settings make adaptive execution split a hot key's partition."""
    names = ("spark.sql.adaptive.skewJoin.skewedPartitionFactor",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name, value in zip(names, ("1.5", "10k", "5k", "-1", "-1")):
        spark.conf.set(name, value)
    try:
        left = _hot(spark).repartition(8, F.rand(1))
        right = spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        joined = left.join(right, "k")
        assert joined.count() == N
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.conf.unset(name)
