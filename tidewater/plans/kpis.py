"""Gold KPIs.

Money is summed exactly as decimal and turned into double once, at the end.

Three KPIs of the reference join two facts on a non-unique key (M:N): K4 on
CustomerKey, K5 and K13 on VehicleKey.  Materialising those joins emits
every (claim, policy) pair of a key -- quadratic in the size of a hot key.
Here each side is first aggregated to one row per key, and the pair sums are
recovered algebraically (SURVEY O1):

    sum over pairs of claim.x  = sum_k  S_k * p_k     (S_k: claim sum, p_k: policy rows)
    sum over pairs of policy.y = sum_k  P_k * c_k     (P_k: policy sum, c_k: claim rows)

so the ``*_as_written`` results equal the fan-out answer exactly while the
shuffle carries one row per key and side.  Partial aggregation before each
exchange keeps hot keys cheap.  The ``corrected`` variants divide totals
that are aggregated independently, which is what a loss ratio means.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _dbl(c: Column) -> Column:
    return c.cast("double")


def _ratio(num: Column, den: Column) -> Column:
    """Ratio of two exact sums as double; NULL when the divisor is 0/NULL."""
    return F.try_divide(_dbl(num), _dbl(den))


def _mean(c: str) -> Column:
    """AVG as exact sum / count, divided once in double (engine-independent)."""
    return F.try_divide(_dbl(F.sum(c)), F.count(c))


# ---------------------------------------------------------------- policies

def portfolio_overview(fact_policy: DataFrame) -> DataFrame:
    """K1: distinct policies, premium and coverage totals."""
    return fact_policy.agg(
        F.count_distinct("PolicyNumber").alias("TotalPolicies"),
        _dbl(F.sum("AnnualPremium_INR")).alias("TotalPremium"),
        _dbl(F.sum("CoverageAmount_INR")).alias("TotalCoverage"))


def premium_by_policy_type(fact_policy: DataFrame) -> DataFrame:
    """K2."""
    return fact_policy.groupBy("PolicyType").agg(
        F.count(F.lit(1)).alias("PolicyCount"),
        _dbl(F.sum("AnnualPremium_INR")).alias("TotalPremium"))


def payment_frequency_mix(policies: DataFrame) -> DataFrame:
    """K8 (reads silver policies, not the fact)."""
    return policies.groupBy("PaymentFrequency").agg(
        F.count(F.lit(1)).alias("PolicyCount"))


def policy_lifecycle(fact_policy: DataFrame) -> DataFrame:
    """K9: new policies per start year."""
    return fact_policy.groupBy(F.year("PolicyStartDate").alias("Year")).agg(
        F.count(F.lit(1)).alias("NewPolicies"))


def policy_expiring(fact_policy: DataFrame) -> DataFrame:
    """K9, second half of its title: policies expiring per year."""
    return fact_policy.groupBy(F.year("PolicyEndDate").alias("Year")).agg(
        F.count(F.lit(1)).alias("ExpiringPolicies"))


def policy_kpis_fused(fact_policy: DataFrame) -> DataFrame:
    """SURVEY O4: K2, K9 and the expiring half of K9 from ONE scan of the
    policy fact, as GROUPING SETS; ``Grouping`` names the KPI of each row.
    (K1's exact distinct count stays separate: inside grouping sets it
    would replicate the rows once per set before the distinct shuffle.)"""
    fp = fact_policy.select(
        "PolicyType", F.year("PolicyStartDate").alias("StartYear"),
        F.year("PolicyEndDate").alias("EndYear"), "AnnualPremium_INR")
    g = fp.groupingSets([["PolicyType"], ["StartYear"], ["EndYear"]],
                        "PolicyType", "StartYear", "EndYear")
    out = g.agg(F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("Policies"),
                _dbl(F.sum("AnnualPremium_INR")).alias("TotalPremium"))
    label = (F.when(F.col("_gid") == 3, "by_policy_type")
              .when(F.col("_gid") == 5, "new_by_year")
              .otherwise("expiring_by_year"))
    return out.select(label.alias("Grouping"), "PolicyType", "StartYear", "EndYear",
                      "Policies", "TotalPremium")


def agent_performance(policies: DataFrame) -> DataFrame:
    """K10 (reads silver policies)."""
    return policies.groupBy("AgentID", "AgentName").agg(
        F.count(F.lit(1)).alias("PoliciesSold"),
        _dbl(F.sum("AnnualPremium_INR")).alias("TotalPremium"))


def avg_premium_per_customer(fact_policy: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """K11.  The reference joins the dimension only to group by its key;
    duplicating a policy row k times leaves its average unchanged, so a
    semi join (existence of the key) is exact.  Policies are summed per key
    first (partial aggregation map-side), then the per-key rows meet the
    dimension keys."""
    per_key = fact_policy.groupBy("CustomerKey").agg(
        F.sum("AnnualPremium_INR").alias("_s"), F.count("AnnualPremium_INR").alias("_n"))
    keys = dim_customer.select("CustomerKey")
    return (per_key.join(keys, "CustomerKey", "left_semi")
            .select("CustomerKey", F.try_divide(_dbl(F.col("_s")), F.col("_n")).alias("AvgPremium")))


# ------------------------------------------------------------------ claims

def claims_summary(fact_claims: DataFrame) -> DataFrame:
    """K3."""
    return fact_claims.agg(
        F.count("ClaimID").alias("TotalClaims"),
        _dbl(F.sum("ClaimAmount_INR")).alias("ClaimedAmount"),
        _dbl(F.sum("SettledAmount_INR")).alias("SettledAmount"))


def customer_claim_behavior(fact_claims: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """K7: claims and settled amount per customer key.

    Aggregate claims per key first, then join the per-key count of
    dimension rows (m) and scale -- exact even if a key were duplicated."""
    per_key = fact_claims.groupBy("CustomerKey").agg(
        F.count("ClaimID").alias("_n"), F.sum("SettledAmount_INR").alias("_s"))
    dim_rows = dim_customer.groupBy("CustomerKey").agg(F.count(F.lit(1)).alias("_m"))
    return per_key.join(dim_rows, "CustomerKey").select(
        "CustomerKey",
        (F.col("_n") * F.col("_m")).alias("ClaimCount"),
        _dbl(F.col("_s") * F.col("_m")).alias("TotalClaims"))


def _pair_sums(claims: DataFrame, policies: DataFrame, key: str) -> DataFrame:
    """Per key: settled sum/rows of the claims and premium sum/rows of the
    policies, from ONE shuffle (the two sides stacked, then aggregated).
    Keys present on one side only are dropped, like the inner join."""
    c = claims.select(F.col(key), F.col("SettledAmount_INR").alias("_s"),
                      F.lit(1).alias("_c"), F.lit(None).cast("decimal(18,2)").alias("_p_sum"),
                      F.lit(0).alias("_p"))
    p = policies.select(F.col(key), F.lit(None).cast("decimal(24,4)").alias("_s"),
                        F.lit(0).alias("_c"), F.col("AnnualPremium_INR").alias("_p_sum"),
                        F.lit(1).alias("_p"))
    return (c.unionByName(p).where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.sum("_s").alias("_sum_s"), F.sum("_c").alias("_cnt_c"),
                 F.sum("_p_sum").alias("_sum_p"), F.sum("_p").alias("_cnt_p"))
            .where((F.col("_cnt_c") > 0) & (F.col("_cnt_p") > 0)))


def loss_ratio_overall_as_written(fact_claims: DataFrame, fact_policy: DataFrame) -> DataFrame:
    """K4 as the reference defines it: SUM(settled)/SUM(premium) over the
    claims x policies join on CustomerKey -- computed without the join."""
    j = _pair_sums(fact_claims, fact_policy, "CustomerKey")
    return j.agg(_ratio(F.sum(F.col("_sum_s") * F.col("_cnt_p")),
                        F.sum(F.col("_sum_p") * F.col("_cnt_c"))).alias("LossRatio"))


def loss_ratio_overall(fact_claims: DataFrame, fact_policy: DataFrame) -> DataFrame:
    """K4 corrected: total settled over total premium, aggregated apart."""
    # one scan of each fact, stacked, then a single global aggregate
    s = fact_claims.select(F.col("SettledAmount_INR").alias("_S"),
                           F.lit(None).cast("decimal(18,2)").alias("_P"))
    p = fact_policy.select(F.lit(None).cast("decimal(24,4)").alias("_S"),
                           F.col("AnnualPremium_INR").alias("_P"))
    return s.unionByName(p).agg(_ratio(F.sum("_S"), F.sum("_P")).alias("LossRatio"))


def claim_frequency(fact_policy: DataFrame, fact_claims: DataFrame) -> DataFrame:
    """K5: COUNT(claims)/COUNT(DISTINCT vehicles) per policy type over
    policy LEFT JOIN claims ON VehicleKey -- computed without the join.

    Per (type, vehicle) the policy rows n; per vehicle the non-NULL claim ids
    cc; the joined COUNT(ClaimID) is sum(n * cc).  A NULL vehicle key never
    matches, and the distinct vehicle count comes from the policy side."""
    cc = (fact_claims.where(F.col("VehicleKey").isNotNull()).groupBy("VehicleKey")
          .agg(F.count("ClaimID").alias("_cc")))
    pv = fact_policy.groupBy("PolicyType", "VehicleKey").agg(F.count(F.lit(1)).alias("_n"))
    j = pv.join(cc, "VehicleKey", "left")
    return j.groupBy("PolicyType").agg(
        F.try_divide(F.sum(F.col("_n") * F.coalesce(F.col("_cc"), F.lit(0))),
                     F.count("VehicleKey")).cast("double").alias("ClaimFrequency"))


def loss_ratio_by_make_as_written(fact_claims: DataFrame, fact_policy: DataFrame,
                                  dim_vehicle: DataFrame) -> DataFrame:
    """K13 as written: claims JOIN policies ON VehicleKey JOIN vehicles,
    grouped by make; pair sums recovered from per-key aggregates.  Each
    vehicle row repeats its key's pairs once, so joining the per-key sums
    to the raw vehicle rows reproduces the three-way join's multiplicity."""
    per_key = _pair_sums(fact_claims, fact_policy, "VehicleKey")
    v = dim_vehicle.select("VehicleKey", "VehicleMake")
    j = per_key.join(v, "VehicleKey")
    return j.groupBy("VehicleMake").agg(
        _ratio(F.sum(F.col("_sum_s") * F.col("_cnt_p")),
               F.sum(F.col("_sum_p") * F.col("_cnt_c"))).alias("LossRatio"))


def loss_ratio_by_make(fact_claims: DataFrame, fact_policy: DataFrame,
                       dim_vehicle: DataFrame) -> DataFrame:
    """K13 corrected: settled claims per make over premium per make, each
    summed once (claims and policies attach to a make through their vehicle).
    Both facts are summed per vehicle first, so only one row per vehicle and
    side reaches the join with the dimension."""
    v = dim_vehicle.where(F.col("IsCurrent")).select("VehicleKey", "VehicleMake")
    s = fact_claims.groupBy("VehicleKey").agg(F.sum("SettledAmount_INR").alias("_S"))
    p = fact_policy.groupBy("VehicleKey").agg(F.sum("AnnualPremium_INR").alias("_P"))
    s_make = s.join(v, "VehicleKey").groupBy("VehicleMake").agg(F.sum("_S").alias("_S"))
    p_make = p.join(v, "VehicleKey").groupBy("VehicleMake").agg(F.sum("_P").alias("_P"))
    return p_make.join(s_make, "VehicleMake", "left").select(
        "VehicleMake", _ratio(F.col("_S"), F.col("_P")).alias("LossRatio"))


# ---------------------------------------------------------------- customers

def customer_distribution(dim_customer: DataFrame) -> DataFrame:
    """K6."""
    return (dim_customer.where(F.col("IsCurrent"))
            .groupBy("City", "State", "Country")
            .agg(F.count_distinct("CustomerKey").alias("CustomerCount")))


def customer_distribution_rollup(dim_customer: DataFrame) -> DataFrame:
    """K6 with subtotals per country and a grand total (ROLLUP)."""
    return (dim_customer.where(F.col("IsCurrent"))
            .rollup("Country", "State")
            .agg(F.count_distinct("CustomerKey").alias("CustomerCount")))


# ---------------------------------------------------------------- payments

def payment_collection(fact_payments: DataFrame) -> DataFrame:
    """K12."""
    return fact_payments.agg(
        F.count("TransactionID").alias("TotalPayments"),
        _dbl(F.sum("Amount_INR")).alias("TotalCollected"),
        _mean("Amount_INR").alias("AvgPayment"))
