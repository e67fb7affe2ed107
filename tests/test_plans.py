"""Plan-shape checks: what the physical plans must and must not contain."""

import pytest

from __spark_entry__ import queries

from shared import SMALL

# queries whose builders only plan (no landing writes or streams)
WRITING = ("kpi_tables_by_name", "dim_customer_increment", "dim_customer_increment_out_of_order")
PLANNED = sorted(n for n in queries() if n.startswith(("fact_", "kpi_", "silver_", "dq_", "dim_")) and n not in WRITING
                 or n in ("payments_late_flag", "harmonize_schemas", "mask_pii_text",
                          "encrypt_roundtrip", "encrypt_selected_gcm", "encrypted_key_join",
                          "keyed_token_groups", "audit_layer_counts", "text_standardize",
                          "json_flatten_struct", "route_files_theta_join"))


def _plan(spark, name):
    return queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cartesian_no_python(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert "NestedLoopJoin" not in plan


def test_claim_filter_reaches_the_scan(spark):
    plan = _plan(spark, "fact_claims")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan


def test_kpi_reads_only_needed_columns(spark):
    plan = _plan(spark, "kpi_loss_ratio_overall_as_written")
    assert "ReadSchema: struct<CustomerKey:bigint,SettledAmount_INR:decimal(24,4)>" in plan
    assert "ReadSchema: struct<CustomerKey:bigint,AnnualPremium_INR:decimal(18,2)>" in plan


def test_pair_sums_shuffle_once_per_key(spark):
    plan = _plan(spark, "kpi_loss_ratio_overall_as_written")
    assert plan.count("Exchange hashpartitioning") == 1


def test_merges_refer_to_the_dimension_once(spark):
    """Each further merge adds the same number of scans."""
    from pyspark.sql import functions as F

    from tidewater.operators import scd2
    rows = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("c"), F.lit("2024-01-01").cast("date").alias("d"))
    dim, sizes = scd2.build(rows, "k", ["c"], "d", "key"), []
    for _ in range(5):
        dim = scd2.apply_snapshot(dim, rows, "k", ["c"], "d", "key")
        sizes.append(dim._jdf.queryExecution().optimizedPlan().toString().count("Range ("))
    steps = {b - a for a, b in zip(sizes, sizes[1:])}
    assert steps == {1}
