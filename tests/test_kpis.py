from decimal import Decimal

from hypothesis import given, settings, strategies as st

from tidewater.plans import kpis

FP = "CustomerKey bigint, VehicleKey bigint, PolicyNumber bigint, PolicyType string, AnnualPremium_INR decimal(18,2)"
FC = "ClaimID bigint, CustomerKey bigint, VehicleKey bigint, SettledAmount_INR decimal(24,4)"


def _fanout_ratio(claims, policies):
    """Brute force: every (claim, policy) pair with equal CustomerKey."""
    pairs = [(c, p) for c in claims for p in policies if c[1] is not None and c[1] == p[0]]
    s = [c[3] for c, _ in pairs if c[3] is not None]
    d = [p[4] for _, p in pairs if p[4] is not None]
    if not d or sum(d) == 0 or not s:
        return None
    return float(sum(s)) / float(sum(d))


keys = st.one_of(st.none(), st.integers(0, 4))
money = st.one_of(st.none(), st.decimals(0, 1000, places=2))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(keys, keys, money), max_size=12),
       st.lists(st.tuples(keys, keys, money), max_size=12))
def test_preaggregated_loss_ratio_equals_fan_out(spark, cl, po):
    claims = [(i, a, b, m) for i, (a, b, m) in enumerate(cl)]
    policies = [(a, b, i, "T", m) for i, (a, b, m) in enumerate(po)]
    fc = spark.createDataFrame(claims, FC)
    fp = spark.createDataFrame(policies, FP)
    got = kpis.loss_ratio_overall_as_written(fc, fp).first()["LossRatio"]
    want = _fanout_ratio(claims, policies)
    assert (got is None and want is None) or abs(got - want) <= 1e-12 * max(1, abs(want))


def test_ratios_empty_zero_and_null(spark):
    empty_c = spark.createDataFrame([], FC)
    empty_p = spark.createDataFrame([], FP)
    assert kpis.loss_ratio_overall(empty_c, empty_p).first()["LossRatio"] is None
    fc = spark.createDataFrame([(1, 1, 1, Decimal("5"))], FC)
    fp0 = spark.createDataFrame([(1, 1, 1, "T", Decimal("0"))], FP)
    assert kpis.loss_ratio_overall_as_written(fc, fp0).first()["LossRatio"] is None
    fcn = spark.createDataFrame([(1, 1, 1, None)], FC)
    fpn = spark.createDataFrame([(1, 1, 1, "T", Decimal("3"))], FP)
    assert kpis.loss_ratio_overall_as_written(fcn, fpn).first()["LossRatio"] is None
    r = kpis.payment_collection(spark.createDataFrame(
        [], "TransactionID bigint, Amount_INR decimal(18,2)")).first()
    assert r["TotalPayments"] == 0 and r["TotalCollected"] is None and r["AvgPayment"] is None


def test_claim_frequency_null_vehicle(spark):
    fp = spark.createDataFrame([(1, None, 1, "A", Decimal(1)), (1, 7, 2, "A", Decimal(1))], FP)
    fc = spark.createDataFrame([(1, 1, 7, Decimal(1)), (2, 1, 7, Decimal(1)), (3, 1, None, Decimal(1))], FC)
    r = kpis.claim_frequency(fp, fc).first()
    assert r["PolicyType"] == "A" and r["ClaimFrequency"] == 2.0


def test_no_cartesian_product_in_kpis(spark):
    fc = spark.createDataFrame([(1, 1, 7, Decimal(1))], FC)
    fp = spark.createDataFrame([(1, 7, 2, "A", Decimal(1))], FP)
    for df in (kpis.loss_ratio_overall(fc, fp), kpis.loss_ratio_overall_as_written(fc, fp)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_run_kpis_writes_every_table(spark, tmp):
    from tidewater.plans import layers
    from tidewater.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    w.materialize_facts(f"{tmp}/gold")
    tables = layers.kpi_tables(w.fact_policy, w.fact_claims, w.fact_payments,
                               w.dim_customer, w.dim_vehicle, w.policies_with_agent)
    written = layers.run_kpis(tables, f"{tmp}/kpi", max_parallel=4)
    assert set(written) == set(tables)
    for name, df in tables.items():
        assert sorted(spark.read.parquet(written[name]).collect()) == sorted(df.collect()), name


def test_cluster_conf_scales_with_input():
    from tidewater.session import cluster_conf
    small = cluster_conf(10 << 30, 64)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 192          # 3 waves over 64 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 24_000         # of what is shuffled, not of splits
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_warehouse_refresh(spark):
    from tidewater.plans.warehouse import Warehouse
    a = Warehouse.of(spark, "/root/testdata/sf0.001")
    assert Warehouse.of(spark, "/root/testdata/sf0.001") is a
    Warehouse.refresh()
    assert Warehouse.of(spark, "/root/testdata/sf0.001") is not a
