"""Layer runs: each entity landed in one pass, only the named silver tables run."""

from pyspark.sql import functions as F

from tidewater.operators import versioned
from tidewater.plans import bronze, layers
from tidewater.sources.files import csv_header, read_csv

KEY = "0123456789abcdef"


def test_deliveries_land_from_one_pass(spark, tmp):
    passes = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            passes.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(i, None if i % 4 == 0 else f"a,\"{i}", f"2024-0{1 + i % 3}-01") for i in range(30)],
                                 "id long, t string, day string").repartition(2)
    name = F.concat(F.lit("feed x_"), "day", F.lit(".csv"))
    bronze.land_csv(rows.mapInArrow(counted, rows.schema), f"{tmp}/land", name, "day")
    assert passes.value == 30
    for m in range(3):
        path = f"{tmp}/land/feed x_2024-0{1 + m}-01.csv"
        assert csv_header(spark, path) == ("id", "t")
        got = {(r["id"], r["t"]) for r in read_csv(spark, [path]).collect()}
        assert got == {(str(i), None if i % 4 == 0 else f"a,\"{i}") for i in range(m, 30, 3)}


def test_only_the_named_silver_tables_run(spark, tmp):
    claims = spark.createDataFrame([(1, "5"), (1, "6"), (None, "7")], "ClaimID long, SettledAmount_INR string")
    rows = claims.selectExpr("ClaimID", "1L AS CustomerID", "1L AS PolicyNumber", "'2024-01-01' AS ClaimDate",
                             "'2024-01-01' AS SettlementDate", "'1' AS ClaimAmount_INR", "SettledAmount_INR",
                             "'c' AS _src_country", "'2024-01-01' AS SnapshotDate", "'f' AS FileName")
    for source in ("policy_claims", "policy_payments"):
        rows.write.partitionBy("_src_country", "SnapshotDate", "FileName").parquet(f"{tmp}/bronze/{source}")
    done = layers.run_silver(spark, f"{tmp}/bronze", f"{tmp}/silver", KEY, as_written=True, tables=["claims"])
    assert list(done) == ["claims"] and not versioned.versions(spark, f"{tmp}/silver/payments")
    assert layers.read_silver(spark, f"{tmp}/silver", "claims").count() == 2
