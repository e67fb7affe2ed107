"""Registry of checked queries: name -> (Spark builder, oracle SQL).

A builder takes ``(spark, data_root)`` and returns a lazy DataFrame over the
driver's tables.  Output columns are aliased identically in both forms.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import protect, text
from ..functions.parse import parse_date, parse_int, rejected
from ..operators import incremental, provenance, quality, routing, scd2
from ..session import scratch_path
from ..sources import views as _views
from ..sources import workbooks
from ..sources.views import SNAPSHOT_DATES
from ..streaming import jobs as stream_jobs
from . import bronze, gold, kpis, layers, silver
from .oracle import with_views
from .warehouse import Warehouse

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql=None`` marks it rows-only (no SQL form)."""
    def deco(fn: Callable[[Warehouse], DataFrame]):
        def build(spark: SparkSession, root: str) -> DataFrame:
            return fn(Warehouse.of(spark, root))
        build.__name__ = name
        build.__doc__ = fn.__doc__
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn
    return deco


# ===================================================================== facts

@register("fact_policy", """
SELECT CustomerKey, VehicleKey, PolicyNumber, PolicyType,
       CAST(AnnualPremium_INR AS DOUBLE) AS AnnualPremium_INR,
       CAST(CoverageAmount_INR AS DOUBLE) AS CoverageAmount_INR,
       PolicyStartDate, PolicyEndDate
FROM fact_policy""")
def _fact_policy(w: Warehouse) -> DataFrame:
    """policies x current customer (inner) x current vehicle (left)."""
    return gold.money_as_double(w.fact_policy)


@register("fact_claims", """
SELECT ClaimID, CustomerKey, VehicleKey, ClaimDate,
       CAST(ClaimAmount_INR AS DOUBLE) AS ClaimAmount_INR,
       CAST(SettledAmount_INR AS DOUBLE) AS SettledAmount_INR
FROM fact_claims""")
def _fact_claims(w: Warehouse) -> DataFrame:
    """F2."""
    return gold.money_as_double(w.fact_claims)


@register("fact_payments", """
SELECT TransactionID, CustomerKey, CAST(Amount_INR AS DOUBLE) AS Amount_INR, PaidDate
FROM fact_payments""")
def _fact_payments(w: Warehouse) -> DataFrame:
    """F3."""
    return gold.money_as_double(w.fact_payments)


# ====================================================================== KPIs

@register("kpi_portfolio_overview", """
SELECT COUNT(DISTINCT PolicyNumber) AS TotalPolicies,
       CAST(SUM(AnnualPremium_INR) AS DOUBLE) AS TotalPremium,
       CAST(SUM(CoverageAmount_INR) AS DOUBLE) AS TotalCoverage
FROM fact_policy""")
def _k1(w: Warehouse) -> DataFrame:
    return kpis.portfolio_overview(w.gold.fact_policy)


@register("kpi_premium_by_policy_type", """
SELECT PolicyType, COUNT(*) AS PolicyCount,
       CAST(SUM(AnnualPremium_INR) AS DOUBLE) AS TotalPremium
FROM fact_policy GROUP BY PolicyType""")
def _k2(w: Warehouse) -> DataFrame:
    return kpis.premium_by_policy_type(w.gold.fact_policy)


@register("kpi_claims_summary", """
SELECT COUNT(ClaimID) AS TotalClaims,
       CAST(SUM(ClaimAmount_INR) AS DOUBLE) AS ClaimedAmount,
       CAST(SUM(SettledAmount_INR) AS DOUBLE) AS SettledAmount
FROM fact_claims""")
def _k3(w: Warehouse) -> DataFrame:
    return kpis.claims_summary(w.gold.fact_claims)


@register("kpi_loss_ratio_overall_as_written", """
SELECT CAST(SUM(fc.SettledAmount_INR) AS DOUBLE)
       / NULLIF(CAST(SUM(fp.AnnualPremium_INR) AS DOUBLE), 0) AS LossRatio
FROM fact_claims fc JOIN fact_policy fp ON fc.CustomerKey = fp.CustomerKey""")
def _k4w(w: Warehouse) -> DataFrame:
    """K4 as written (M:N join semantics), computed from per-key aggregates."""
    return kpis.loss_ratio_overall_as_written(w.gold.fact_claims, w.gold.fact_policy)


@register("kpi_loss_ratio_overall", """
SELECT CAST((SELECT SUM(SettledAmount_INR) FROM fact_claims) AS DOUBLE)
       / NULLIF(CAST((SELECT SUM(AnnualPremium_INR) FROM fact_policy) AS DOUBLE), 0)
       AS LossRatio""")
def _k4(w: Warehouse) -> DataFrame:
    """K4 corrected: independently aggregated totals."""
    return kpis.loss_ratio_overall(w.gold.fact_claims, w.gold.fact_policy)


@register("kpi_claim_frequency", """
SELECT fp.PolicyType,
       CAST(COUNT(fc.ClaimID) AS DOUBLE) / NULLIF(COUNT(DISTINCT fp.VehicleKey), 0)
         AS ClaimFrequency
FROM fact_policy fp LEFT JOIN fact_claims fc ON fp.VehicleKey = fc.VehicleKey
GROUP BY fp.PolicyType""")
def _k5(w: Warehouse) -> DataFrame:
    return kpis.claim_frequency(w.gold.fact_policy, w.gold.fact_claims)


@register("kpi_customer_distribution", """
SELECT City, State, Country, COUNT(DISTINCT CustomerKey) AS CustomerCount
FROM dim_customer WHERE IsCurrent = true GROUP BY City, State, Country""")
def _k6(w: Warehouse) -> DataFrame:
    return kpis.customer_distribution(w.gold.dim_customer)


@register("kpi_customer_distribution_rollup", """
SELECT Country, State, COUNT(DISTINCT CustomerKey) AS CustomerCount
FROM dim_customer WHERE IsCurrent = true GROUP BY ROLLUP (Country, State)""")
def _k6r(w: Warehouse) -> DataFrame:
    """Extra (not in the reference): K6 with ROLLUP subtotals."""
    return kpis.customer_distribution_rollup(w.gold.dim_customer)


@register("kpi_customer_claim_behavior", """
SELECT dc.CustomerKey, COUNT(fc.ClaimID) AS ClaimCount,
       CAST(SUM(fc.SettledAmount_INR) AS DOUBLE) AS TotalClaims
FROM fact_claims fc JOIN dim_customer dc ON fc.CustomerKey = dc.CustomerKey
GROUP BY dc.CustomerKey""")
def _k7(w: Warehouse) -> DataFrame:
    return kpis.customer_claim_behavior(w.gold.fact_claims, w.gold.dim_customer)


@register("kpi_payment_frequency_mix", """
SELECT PaymentFrequency, COUNT(*) AS PolicyCount FROM policies GROUP BY PaymentFrequency""")
def _k8(w: Warehouse) -> DataFrame:
    return kpis.payment_frequency_mix(w.policies)


@register("kpi_policy_lifecycle", """
SELECT CAST(year(PolicyStartDate) AS INTEGER) AS Year, COUNT(*) AS NewPolicies
FROM fact_policy GROUP BY year(PolicyStartDate)""")
def _k9(w: Warehouse) -> DataFrame:
    return kpis.policy_lifecycle(w.gold.fact_policy)


@register("kpi_policy_expiring", """
SELECT CAST(year(PolicyEndDate) AS INTEGER) AS Year, COUNT(*) AS ExpiringPolicies
FROM fact_policy GROUP BY year(PolicyEndDate)""")
def _k9e(w: Warehouse) -> DataFrame:
    return kpis.policy_expiring(w.gold.fact_policy)


@register("kpi_policy_fused", """
SELECT CASE GROUPING(PolicyType, StartYear, EndYear) WHEN 3 THEN 'by_policy_type'
            WHEN 5 THEN 'new_by_year' ELSE 'expiring_by_year' END AS "Grouping",
       PolicyType, StartYear, EndYear, COUNT(*) AS Policies,
       CAST(SUM(AnnualPremium_INR) AS DOUBLE) AS TotalPremium
FROM (SELECT PolicyType, CAST(year(PolicyStartDate) AS INTEGER) AS StartYear,
             CAST(year(PolicyEndDate) AS INTEGER) AS EndYear, AnnualPremium_INR FROM fact_policy)
GROUP BY GROUPING SETS ((PolicyType), (StartYear), (EndYear))""")
def _k_fused(w: Warehouse) -> DataFrame:
    """K2 + K9 (new and expiring) in one scan of the fact."""
    return kpis.policy_kpis_fused(w.gold.fact_policy)


@register("kpi_agent_performance", """
SELECT AgentID, AgentName, COUNT(*) AS PoliciesSold,
       CAST(SUM(AnnualPremium_INR) AS DOUBLE) AS TotalPremium
FROM policies GROUP BY AgentID, AgentName""")
def _k10(w: Warehouse) -> DataFrame:
    return kpis.agent_performance(w.policies_with_agent)


@register("kpi_avg_premium_per_customer", """
SELECT dc.CustomerKey,
       CAST(SUM(fp.AnnualPremium_INR) AS DOUBLE) / NULLIF(COUNT(fp.AnnualPremium_INR), 0)
         AS AvgPremium
FROM fact_policy fp JOIN dim_customer dc ON fp.CustomerKey = dc.CustomerKey
GROUP BY dc.CustomerKey""")
def _k11(w: Warehouse) -> DataFrame:
    return kpis.avg_premium_per_customer(w.gold.fact_policy, w.gold.dim_customer)


@register("kpi_payment_collection", """
SELECT COUNT(TransactionID) AS TotalPayments,
       CAST(SUM(Amount_INR) AS DOUBLE) AS TotalCollected,
       CAST(SUM(Amount_INR) AS DOUBLE) / NULLIF(COUNT(Amount_INR), 0) AS AvgPayment
FROM fact_payments""")
def _k12(w: Warehouse) -> DataFrame:
    return kpis.payment_collection(w.gold.fact_payments)


@register("kpi_loss_ratio_as_written", """
SELECT dv.VehicleMake,
       CAST(SUM(fc.SettledAmount_INR) AS DOUBLE)
       / NULLIF(CAST(SUM(fp.AnnualPremium_INR) AS DOUBLE), 0) AS LossRatio
FROM fact_claims fc
JOIN fact_policy fp ON fc.VehicleKey = fp.VehicleKey
JOIN dim_vehicle dv ON fp.VehicleKey = dv.VehicleKey
GROUP BY dv.VehicleMake""")
def _k13w(w: Warehouse) -> DataFrame:
    """K13 as written (M:N), from per-key aggregates."""
    return kpis.loss_ratio_by_make_as_written(w.gold.fact_claims, w.gold.fact_policy, w.gold.dim_vehicle)


@register("kpi_loss_ratio", """
WITH v AS (SELECT VehicleKey, VehicleMake FROM dim_vehicle WHERE IsCurrent),
s AS (SELECT v.VehicleMake, SUM(fc.SettledAmount_INR) AS S
      FROM fact_claims fc JOIN v ON fc.VehicleKey = v.VehicleKey GROUP BY v.VehicleMake),
p AS (SELECT v.VehicleMake, SUM(fp.AnnualPremium_INR) AS P
      FROM fact_policy fp JOIN v ON fp.VehicleKey = v.VehicleKey GROUP BY v.VehicleMake)
SELECT p.VehicleMake, CAST(s.S AS DOUBLE) / NULLIF(CAST(p.P AS DOUBLE), 0) AS LossRatio
FROM p LEFT JOIN s ON p.VehicleMake = s.VehicleMake""")
def _k13(w: Warehouse) -> DataFrame:
    """K13 corrected: per-make totals aggregated apart."""
    return kpis.loss_ratio_by_make(w.gold.fact_claims, w.gold.fact_policy, w.gold.dim_vehicle)


# ==================================================================== silver



# Test-only AES key (a real run passes the key from a secret store).
DEMO_KEY = "0123456789abcdef"
CUSTOMER_PII = ("FirstName", "LastName", "Email", "Phone")
CUSTOMER_ATTRS = ("City", "State", "Country")


@register("silver_customers", """
SELECT CustomerID, FirstName, LastName, lower(Email) AS Email,
       regexp_replace(Phone, '\\D', '', 'g') AS Phone,
       TRY_CAST(DOB AS DATE) AS DOB, TRY_CAST(Age AS INTEGER) AS Age,
       City, State, Country, _src_country, SnapshotDate, FileName
FROM bronze_customers""")
def _silver_customers(w: Warehouse) -> DataFrame:
    """L1 (P7, P8, P12, P15): every snapshot row, typed and standardised."""
    return silver.clean_customers(w.bronze_customers)


@register("silver_policies_dedup", """
SELECT PolicyNumber, CustomerID, PolicyType, PaymentFrequency, AgentID, AgentName,
       CAST(CoverageAmount_INR AS DOUBLE) AS CoverageAmount_INR,
       CAST(AnnualPremium_INR AS DOUBLE) AS AnnualPremium_INR,
       PolicyStartDate, PolicyEndDate, _src_country, SnapshotDate, FileName
FROM silver_policies""")
def _silver_policies(w: Warehouse) -> DataFrame:
    """L2 (W1, P3, P12, P16, P21): latest snapshot per policy, typed, filled."""
    return gold.money_as_double(w.silver_policies)


@register("silver_claims", """
SELECT ClaimID, CustomerID, PolicyNumber, ClaimDate, SettlementDate,
       CAST(ClaimAmount_INR AS DOUBLE) AS ClaimAmount_INR,
       CAST(SettledAmount_INR AS DOUBLE) AS SettledAmount_INR
FROM claims""")
def _silver_claims(w: Warehouse) -> DataFrame:
    """L3: claims landed as text, typed back."""
    return gold.money_as_double(silver.clean_claims(_views.bronze_claims(w.t)))


@register("payments_late_flag", """
SELECT TransactionID, CustomerID, ScheduledDate, PaidDate,
       CAST(Amount_INR AS DOUBLE) AS Amount_INR,
       CASE WHEN PaidDate > ScheduledDate THEN 1 ELSE 0 END AS IsLate
FROM payments""")
def _payments_late(w: Warehouse) -> DataFrame:
    """L4 (P18): typed payments with the late flag; unpaid counts as not late."""
    return gold.money_as_double(w.payments)


@register("payments_overdue_summary", """
SELECT IsLate, PaidDate IS NULL AS Unpaid, COUNT(*) AS Instalments,
       CAST(SUM(Amount_INR) AS DOUBLE) AS Amount
FROM (SELECT *, CASE WHEN PaidDate > ScheduledDate THEN 1 ELSE 0 END AS IsLate FROM payments)
GROUP BY IsLate, PaidDate IS NULL""")
def _payments_overdue(w: Warehouse) -> DataFrame:
    """Late / on-time / unpaid instalment counts and amounts."""
    return (w.payments.groupBy("IsLate", F.col("PaidDate").isNull().alias("Unpaid"))
            .agg(F.count(F.lit(1)).alias("Instalments"),
                 F.sum("Amount_INR").cast("double").alias("Amount")))


@register("text_standardize", """
SELECT CustomerID, SnapshotDate,
       upper(substr(_src_country, 1, 1)) || lower(substr(_src_country, 2)) AS CountryName,
       regexp_extract(FileName, '([^/]+)$', 1) AS BaseName,
       lower(regexp_extract(FileName, '\\.([A-Za-z0-9]+)$', 1)) AS Extension,
       lower(Email) AS Email, regexp_replace(Phone, '\\D', '', 'g') AS PhoneDigits
FROM bronze_customers""")
def _text_standardize(w: Warehouse) -> DataFrame:
    """The reference's driver-side string handling as Columns."""
    b = w.bronze_customers
    return b.select(
        "CustomerID", "SnapshotDate",
        text.country_name("_src_country").alias("CountryName"),
        text.file_name_of("FileName").alias("BaseName"),
        text.file_extension("FileName").alias("Extension"),
        text.normalize_email("Email").alias("Email"),
        text.normalize_phone("Phone").alias("PhoneDigits"))


@register("dq_quarantine", """
SELECT CustomerID, SnapshotDate, reason FROM (
  SELECT CustomerID, SnapshotDate, 'bad_dob' AS reason FROM bronze_customers
  WHERE DOB IS NOT NULL AND TRY_CAST(DOB AS DATE) IS NULL
  UNION ALL
  SELECT CustomerID, SnapshotDate, 'bad_age' FROM bronze_customers
  WHERE Age IS NOT NULL AND TRY_CAST(Age AS INTEGER) IS NULL)""")
def _dq_quarantine(w: Warehouse) -> DataFrame:
    """Q4 (D8): rows whose DOB or Age text does not parse, with the reason."""
    b = w.bronze_customers
    return quality.quarantine(b, {
        "bad_dob": rejected("DOB", parse_date("DOB")),
        "bad_age": rejected("Age", parse_int("Age")),
    }, ["CustomerID", "SnapshotDate"])


@register("dq_duplicates", """
SELECT PolicyNumber, COUNT(*) AS row_count, COUNT(DISTINCT SnapshotDate) AS snapshots
FROM bronze_policies GROUP BY PolicyNumber HAVING COUNT(*) > 1""")
def _dq_duplicates(w: Warehouse) -> DataFrame:
    """Q2: policy numbers delivered more than once across snapshots."""
    return quality.duplicate_keys(w.bronze_policies, ["PolicyNumber"],
                                  F.count_distinct("SnapshotDate").alias("snapshots"))


@register("dq_orphans", """
SELECT p.PolicyNumber, p.CustomerID FROM policies p
WHERE NOT EXISTS (SELECT 1 FROM dim_vehicle v
                  WHERE v.PolicyNumber = p.PolicyNumber AND v.IsCurrent)""")
def _dq_orphans(w: Warehouse) -> DataFrame:
    """Q3: policies with no current vehicle row (left anti join)."""
    dv = w.dim_vehicle.where("IsCurrent").select("PolicyNumber")
    return quality.orphans(w.policies.select("PolicyNumber", "CustomerID"), dv, ["PolicyNumber"])


@register("dq_profile", """
WITH bp AS (SELECT CAST(PolicyNumber AS VARCHAR) AS PolicyNumber,
                   CAST(CustomerID AS VARCHAR) AS CustomerID, PolicyType, PaymentFrequency,
                   CAST(AgentID AS VARCHAR) AS AgentID, AgentName, CoverageAmount_INR,
                   AnnualPremium_INR, PolicyStartDate, PolicyEndDate, _src_country,
                   SnapshotDate, FileName FROM bronze_policies)
SELECT column_name, COUNT(*) AS row_count, COUNT(*) - COUNT(value) AS null_count,
       COUNT(DISTINCT value) AS distinct_count
FROM bp UNPIVOT INCLUDE NULLS (value FOR column_name IN (
  PolicyNumber, CustomerID, PolicyType, PaymentFrequency, AgentID, AgentName,
  CoverageAmount_INR, AnnualPremium_INR, PolicyStartDate, PolicyEndDate, _src_country,
  SnapshotDate, FileName))
GROUP BY column_name""")
def _dq_profile(w: Warehouse) -> DataFrame:
    """Q1: null and distinct counts of every bronze policy column."""
    return quality.profile(w.bronze_policies)


@register("audit_layer_counts", """
SELECT 'bronze_policies' AS layer, COUNT(*) AS row_count,
       CAST(SUM(TRY_CAST(AnnualPremium_INR AS DECIMAL(18,2))) AS DOUBLE) AS amount_total
FROM bronze_policies
UNION ALL
SELECT 'silver_policies', COUNT(*), CAST(SUM(AnnualPremium_INR) AS DOUBLE) FROM silver_policies
UNION ALL
SELECT 'fact_policy', COUNT(*), CAST(SUM(AnnualPremium_INR) AS DOUBLE) FROM fact_policy
UNION ALL
SELECT 'fact_claims', COUNT(*), CAST(SUM(SettledAmount_INR) AS DOUBLE) FROM fact_claims
UNION ALL
SELECT 'fact_payments', COUNT(*), CAST(SUM(Amount_INR) AS DOUBLE) FROM fact_payments""")
def _audit(w: Warehouse) -> DataFrame:
    """Q5: rows and amounts per layer, stacked."""
    bronze = w.bronze_policies.withColumn(
        "AnnualPremium_INR", F.col("AnnualPremium_INR").try_cast("decimal(18,2)"))
    return quality.audit([
        ("bronze_policies", bronze, "AnnualPremium_INR"),
        ("silver_policies", w.silver_policies, "AnnualPremium_INR"),
        ("fact_policy", w.gold.fact_policy, "AnnualPremium_INR"),
        ("fact_claims", w.gold.fact_claims, "SettledAmount_INR"),
        ("fact_payments", w.gold.fact_payments, "Amount_INR"),
    ])


# Fixed alias map: snake_case feed names -> the common PascalCase schema
POLICY_ALIASES = {
    "policy_number": "PolicyNumber", "customer_id": "CustomerID",
    "policy_type": "PolicyType", "payment_frequency": "PaymentFrequency",
    "annual_premium": "AnnualPremium_INR", "coverage_amount": "CoverageAmount_INR",
    "start_date": "PolicyStartDate",
}
POLICY_COMMON = ("PolicyNumber", "CustomerID", "PolicyType", "PaymentFrequency",
                 "AnnualPremium_INR", "CoverageAmount_INR", "PolicyStartDate", "PolicyEndDate")


@register("harmonize_schemas", """
SELECT PolicyNumber, CustomerID, PolicyType, PaymentFrequency,
       CAST(AnnualPremium_INR AS DOUBLE) AS AnnualPremium_INR,
       CAST(CoverageAmount_INR AS DOUBLE) AS CoverageAmount_INR, PolicyStartDate,
       CASE WHEN PaymentFrequency = 'F' THEN NULL ELSE PolicyEndDate END AS PolicyEndDate
FROM policies""")
def _harmonize(w: Warehouse) -> DataFrame:
    """Q6: two country feeds with different naming styles -> one schema.

    Finished ('F') policies arrive from a feed with snake_case names and no
    end date; the rest in the common names."""
    p = w.policies
    common = p.where(F.col("PaymentFrequency") != "F")
    snake = p.where(F.col("PaymentFrequency") == "F").select(
        *[F.col(v).alias(k) for k, v in POLICY_ALIASES.items()])
    return gold.money_as_double(quality.union_feeds([
        quality.harmonize(common, {}, POLICY_COMMON),
        quality.harmonize(snake, POLICY_ALIASES, POLICY_COMMON)]))


# the phone shapes of ``text.PHONE_PATTERN``, written out for the check
PHONE_SQL = (r"((\+|\b00)\d{1,3}[ .-]?(\(\d{1,5}\)|\d{1,5})([ .-]?\d{2,6}){1,4}\b"
             r"|\(\d{2,5}\)[ .-]?\d{2,6}([ .-]?\d{2,6}){0,3}\b|\b\d{3}[ .-]\d{3}[ .-]\d{4}\b)")


@register("mask_pii_text", rf"""
SELECT doc_id,
       len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}')) AS n_emails,
       len(regexp_extract_all(m, '{PHONE_SQL}')) AS n_phones, regexp_replace(m, '{PHONE_SQL}', '<PHONE>', 'g') AS masked_text
FROM (SELECT *, regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}', '<EMAIL>', 'g') AS m FROM documents)""")
def _mask_pii(w: Warehouse) -> DataFrame:
    """Q7: count and mask e-mails and phone numbers in free text (whole texts)."""
    d = text.with_masked(w.t.documents.select("doc_id", "text"), "text")
    return d.select("doc_id", "n_emails", "n_phones", "masked_text")


# ================================================================ protection

@register("encrypt_roundtrip", """
SELECT CustomerID, SnapshotDate, FirstName, LastName, Email, Phone FROM bronze_customers""")
def _encrypt_roundtrip(w: Warehouse) -> DataFrame:
    """C1 + C3 (RT): decrypt(encrypt(x)) = x for the PII columns, ECB."""
    b = w.bronze_customers.select("CustomerID", "SnapshotDate", *CUSTOMER_PII)
    enc = protect.protect_columns(b, CUSTOMER_PII, DEMO_KEY, "ECB")
    return protect.unprotect_columns(enc, CUSTOMER_PII, DEMO_KEY, "ECB", strict=True)


@register("encrypt_selected_gcm", """
SELECT CustomerID, SnapshotDate, FirstName, LastName, lower(Email) AS Email,
       regexp_replace(Phone, '\\D', '', 'g') AS Phone, City
FROM bronze_customers""")
def _encrypt_gcm(w: Warehouse) -> DataFrame:
    """C2 + C4 (RT) with D1: standardise first, encrypt the listed columns
    (GCM, random IV), leave the rest alone; decrypt restores them."""
    b = silver.clean_customers(w.bronze_customers).select(
        "CustomerID", "SnapshotDate", *CUSTOMER_PII, "City")
    enc = protect.protect_columns(b, CUSTOMER_PII + ("NotAColumn",), DEMO_KEY, "GCM")
    return protect.unprotect_columns(enc, CUSTOMER_PII, DEMO_KEY, "GCM")


@register("encrypted_key_join", """
SELECT a.Email, COUNT(*) AS matches
FROM bronze_customers a JOIN bronze_customers b ON a.Email = b.Email GROUP BY a.Email""")
def _encrypted_join(w: Warehouse) -> DataFrame:
    """ECB is deterministic, so equi-joins on ciphertext give the
    plaintext answer.  All rows joined with all rows on encrypted e-mail.

    The join runs on per-ciphertext counts (one row per value and side), so
    an e-mail repeated on both sides multiplies counts instead of emitting
    every pair."""
    side = lambda name: (w.bronze_customers
                         .select(protect.encrypt("Email", DEMO_KEY).alias("EmailEnc"))
                         .groupBy("EmailEnc").agg(F.count(F.lit(1)).alias(name)))
    return side("_a").join(side("_c"), "EmailEnc").select(
        protect.decrypt("EmailEnc", DEMO_KEY).alias("Email"), (F.col("_a") * F.col("_c")).alias("matches"))


def _pad(byte: int) -> str:
    return "".join(f"\\x{(b ^ byte):02X}" for b in DEMO_KEY.encode().ljust(64, b"\0"))


@register("keyed_token_groups", f"""
SELECT sha256('{_pad(0x5C)}'::BLOB || unhex(sha256('{_pad(0x36)}'::BLOB || encode(Email)))) AS EmailToken,
       COUNT(*) AS rows_per_token
FROM bronze_customers GROUP BY Email""")
def _token_groups(w: Warehouse) -> DataFrame:
    """D3: keyed HMAC token as the joinable stand-in for a GCM column."""
    return (w.bronze_customers.select(protect.token("Email", DEMO_KEY).alias("EmailToken"))
            .groupBy("EmailToken").agg(F.count(F.lit(1)).alias("rows_per_token")))


# ================================================================ dimensions

def _customer_snapshots(w: Warehouse) -> DataFrame:
    return w.bronze_customers.withColumn("SnapshotDate", parse_date("SnapshotDate"))


def _build_customer_dim(rows: DataFrame) -> DataFrame:
    return scd2.build(rows, "CustomerID", CUSTOMER_ATTRS, "SnapshotDate", "CustomerKey",
                      order=[F.col("FileName").desc()])


SCD2_COLUMNS = ("CustomerKey", "CustomerID", "City", "State", "Country",
                "EffectiveFrom", "EffectiveTo", "IsCurrent")


@register("dim_customer_scd2", "SELECT * FROM dim_customer_scd2")
def _dim_scd2(w: Warehouse) -> DataFrame:
    """M1 + M2: customer dimension rebuilt from all snapshots."""
    return _build_customer_dim(_customer_snapshots(w)).select(*SCD2_COLUMNS)


@register("dim_customer_increment", "SELECT * FROM dim_customer_scd2")
def _dim_increment(w: Warehouse) -> DataFrame:
    """M4: build from the first snapshot, then merge the later ones one by
    one, each into the written dimension of the day before; must equal the
    full rebuild."""
    return _merged_dim(w, sorted(SNAPSHOT_DATES), late=False)


def _merged_dim(w: Warehouse, dates: list[str], late: bool) -> DataFrame:
    rows = _customer_snapshots(w)
    root = scratch_path(w.spark, "dim-increment")
    day = lambda d: rows.where(F.col("SnapshotDate") == F.lit(d).cast("date"))
    dim = _build_customer_dim(day(dates[0]))
    for i, d in enumerate(dates[1:]):
        dim.write.parquet(f"{root}/{i}")
        seen = rows.where(F.col("SnapshotDate").cast("string").isin(dates[:i + 1]))
        dim = scd2.apply_snapshot(w.spark.read.parquet(f"{root}/{i}"), day(d), "CustomerID", CUSTOMER_ATTRS,
                                  "SnapshotDate", "CustomerKey", order=[F.col("FileName").desc()],
                                  history=seen if late else None)
    return dim.select(*SCD2_COLUMNS)


@register("dim_customer_increment_out_of_order", "SELECT * FROM dim_customer_scd2")
def _dim_late(w: Warehouse) -> DataFrame:
    """M4 with late snapshots: the third arrives first, the first last."""
    return _merged_dim(w, [SNAPSHOT_DATES[2], SNAPSHOT_DATES[1], SNAPSHOT_DATES[0]], late=True)


@register("dim_customer_keys", "SELECT CustomerKey, CustomerID, EffectiveFrom FROM dim_customer_scd2")
def _dim_keys(w: Warehouse) -> DataFrame:
    """M2: the surrogate keys."""
    return _build_customer_dim(_customer_snapshots(w)).select("CustomerKey", "CustomerID", "EffectiveFrom")


@register("dim_vehicle_scd2", "SELECT * FROM dim_vehicle_scd2")
def _dim_vehicle_scd2(w: Warehouse) -> DataFrame:
    """M1 for vehicles, from their own feed."""
    rows = _views.bronze_vehicles(w.t).withColumn("SnapshotDate", parse_date("SnapshotDate"))
    return scd2.build(rows, "PolicyNumber", ("VehicleMake",), "SnapshotDate", "VehicleKey",
                      order=[F.col("FileName").desc()]).select(
        "VehicleKey", "PolicyNumber", "VehicleMake", "EffectiveFrom", "EffectiveTo", "IsCurrent")


# Fixed shift of the fixture's claim and payment dates (1995-2001) so that
# they fall before, between and after the dimension's snapshots (2024)
LOOKUP_SHIFT_DAYS = 8400


@register("fact_claims_point_in_time", f"""
SELECT c.ClaimID, c.CustomerID, c.ClaimDate + {LOOKUP_SHIFT_DAYS} AS LookupDate, d.CustomerKey, d.City, d.IsCurrent
FROM claims c LEFT JOIN dim_customer_scd2 d
  ON d.CustomerID = c.CustomerID AND d.EffectiveFrom <= c.ClaimDate + {LOOKUP_SHIFT_DAYS}
 AND coalesce(c.ClaimDate + {LOOKUP_SHIFT_DAYS} < d.EffectiveTo, true)""")
def _claims_point_in_time(w: Warehouse) -> DataFrame:
    """M3: each claim with the customer version valid at its date."""
    return _at_date(w, w.claims, "ClaimID", "ClaimDate")


@register("fact_payments_point_in_time", f"""
SELECT p.TransactionID, p.CustomerID, p.PaidDate + {LOOKUP_SHIFT_DAYS} AS LookupDate, d.CustomerKey, d.City, d.IsCurrent
FROM payments p LEFT JOIN dim_customer_scd2 d
  ON d.CustomerID = p.CustomerID AND d.EffectiveFrom <= p.PaidDate + {LOOKUP_SHIFT_DAYS}
 AND coalesce(p.PaidDate + {LOOKUP_SHIFT_DAYS} < d.EffectiveTo, true)""")
def _payments_point_in_time(w: Warehouse) -> DataFrame:
    """M3: each payment with the customer version valid when paid."""
    return _at_date(w, w.payments, "TransactionID", "PaidDate")


def _at_date(w: Warehouse, rows: DataFrame, id_col: str, date_col: str) -> DataFrame:
    dim = _build_customer_dim(_customer_snapshots(w))
    facts = rows.select(id_col, "CustomerID", F.date_add(date_col, LOOKUP_SHIFT_DAYS).alias("LookupDate"))
    return scd2.as_of_join(facts, dim, "CustomerID", "CustomerID", "LookupDate").select(
        id_col, "CustomerID", "LookupDate", "_d.CustomerKey", "_d.City", "_d.IsCurrent")


@register("fact_events_point_in_time", """
SELECT e.event_id, e.user_id AS CustomerID, CAST(e.ts AS DATE) + 30 AS LookupDate,
       d.CustomerKey, d.City, d.IsCurrent
FROM events e LEFT JOIN dim_customer_scd2 d
  ON d.CustomerID = e.user_id AND d.EffectiveFrom <= CAST(e.ts AS DATE) + 30
 AND (d.EffectiveTo IS NULL OR CAST(e.ts AS DATE) + 30 < d.EffectiveTo)""")
def _point_in_time(w: Warehouse) -> DataFrame:
    """M3: each event gets the customer version valid 30 days after it."""
    dim = _build_customer_dim(_customer_snapshots(w))
    ev = w.t.events.select("event_id", F.col("user_id").alias("CustomerID"),
                           F.date_add(F.to_date("ts"), 30).alias("LookupDate"))
    j = scd2.as_of_join(ev, dim, "CustomerID", "CustomerID", "LookupDate")
    return j.select("_f.event_id", "_f.CustomerID", "_f.LookupDate",
                    "_d.CustomerKey", "_d.City", "_d.IsCurrent")


# ================================================================= ingestion


CUSTOMER_FIXTURE_COLS = ("CustomerID", "FirstName", "LastName", "Email", "Phone", "DOB",
                         "Age", "City", "State", "Country", "_src_country", "SnapshotDate",
                         "FileName")
POLICY_FIXTURE_COLS = ("PolicyNumber", "CustomerID", "PolicyType", "PaymentFrequency",
                       "AgentID", "AgentName", "CoverageAmount_INR", "AnnualPremium_INR",
                       "PolicyStartDate", "PolicyEndDate", "_src_country", "SnapshotDate",
                       "FileName")


def _land(df: DataFrame, snapshot: str) -> DataFrame:
    return df.where(F.col("SnapshotDate") == snapshot).drop(*provenance.META_COLS)


_history = provenance.read_history


@register("bronze_ingest", """
SELECT * REPLACE (CASE WHEN SnapshotDate = '2024-01-01'
       THEN 'insurance_customer_' || CASE CustomerID % 2 WHEN 0 THEN 'b' ELSE 'a' END || '_2024-01-01.csv'
       ELSE FileName END AS FileName)
FROM bronze_customers
UNION ALL
SELECT * REPLACE ('UnitedKingdom' AS _src_country) FROM bronze_customers WHERE SnapshotDate = '2024-03-01'""")
def _bronze_ingest(w: Warehouse) -> DataFrame:
    """I7 end to end (A1, A5, A8, I1-I6, C1-C2, C6, B1, D13): customer extracts
    of two countries land as CSV deliveries, two of them on one day, and come
    in by separate runs, one of which is run again; the job routes, reads,
    encrypts the configured PII, stamps provenance and appends by delivery.
    Read back and decrypted, bronze must hold every landed row once."""
    spark = w.spark
    root = scratch_path(spark, "bronze-ingest")
    d1, d2, d3 = SNAPSHOT_DATES
    rows = lambda d: _land(w.bronze_customers, d)
    deliveries = [
        ("india-1a", "a_" + d1, rows(d1).where("CustomerID % 2 <> 0"), "india"),
        ("india-1b", "b_" + d1, rows(d1).where("CustomerID % 2 = 0"), "india"),
        ("india-2", d2, rows(d2), "India"),
        ("india-3", d3, rows(d3), "INDIA"),
        ("uk-3", d3, rows(d3), "unitedkingdom"),
    ]
    for folder, name, df, _ in deliveries:
        df.write.option("header", True).csv(f"{root}/{folder}/landing/insurance_customer_{name}.csv")
    for folder, _, _, country in [*deliveries, deliveries[0]]:
        bronze.ingest(spark, f"{root}/{folder}/landing", f"{root}/bronze", bronze.config_frame(spark),
                      DEMO_KEY, country)
    hist = _history(spark, f"{root}/bronze/insurance_customer")
    plain = protect.unprotect_columns(hist, CUSTOMER_PII, DEMO_KEY, strict=True)
    return plain.select(*CUSTOMER_FIXTURE_COLS)


# Fixed routing rows for the conforming check: two routes to one table, each
# with its own sensitive list
TWO_ROUTES = [("cust_feed_a", "insurance_customer", "FirstName,LastName,Email,Phone", "Y"),
              ("cust_feed_b", "insurance_customer", "Email", "Y")]


@register("bronze_ingest_conform", """
WITH f AS (SELECT *, CASE SnapshotDate WHEN '2024-01-01' THEN 'cust_feed_a_2024-01-01.csv'
                  WHEN '2024-02-01' THEN 'cust_feed_b_2024-02-01.csv' ELSE 'cust_feed_a_2024-03-01.XLSX' END AS d
           FROM bronze_customers)
SELECT CASE WHEN SnapshotDate = '2024-01-01' AND CustomerID % 50 = 0 THEN NULL ELSE CustomerID END AS CustomerID,
       FirstName, Email, Phone, City,
       CASE WHEN SnapshotDate = '2024-02-01' THEN 'T' || CustomerID % 3 END AS LoyaltyTier,
       SnapshotDate <> '2024-02-01' AS FirstNameProtected, true AS EmailProtected,
       CASE WHEN SnapshotDate = '2024-01-01' AND CustomerID % 50 = 0 THEN 'X' || CustomerID END AS RejectedID,
       SnapshotDate, d AS FileName
FROM f""")
def _ingest_conform(w: Warehouse) -> DataFrame:
    """One table from a CSV with reordered and renamed
    columns and broken ids, a CSV with a new column and a shorter sensitive
    list, and upper-case .XLSX workbooks, together with a file of an unknown
    format that only shows in the report."""
    spark = w.spark
    root = scratch_path(spark, "ingest-conform")
    land = f"{root}/landing"
    d1, d2, d3 = SNAPSHOT_DATES
    first = _land(w.bronze_customers, d1)
    broken = F.when(F.col("CustomerID") % 50 == 0, F.concat(F.lit("X"), "CustomerID")).otherwise(
        F.concat("CustomerID", F.lit(".0")))
    (first.select("Phone", F.col("Email").alias("mail"), broken.alias("customer_id"), F.col("LastName").alias("last_name"),
                  "City", F.col("FirstName").alias("FIRSTNAME"), "State", "DOB", "Country", "Age")
     .write.option("header", True).csv(f"{land}/cust_feed_a_{d1}.csv"))
    (_land(w.bronze_customers, d2).withColumn("LoyaltyTier", F.concat(F.lit("T"), F.col("CustomerID") % 3))
     .write.option("header", True).csv(f"{land}/cust_feed_b_{d2}.csv"))
    workbooks.write_xlsx(_land(w.bronze_customers, d3), f"{land}/cust_feed_a_{d3}.XLSX")
    first.select("FirstName").write.text(f"{land}/cust_feed_a_{d1}.txt")
    report = bronze.ingest(spark, land, f"{root}/bronze", bronze.config_frame(spark, TWO_ROUTES), DEMO_KEY, "india")
    odd = report.where("status = 'unknown format'").select(F.count(F.lit(1))).scalar()
    h = _history(spark, f"{root}/bronze/insurance_customer")
    shown = lambda c: F.coalesce(protect.decrypt(c, DEMO_KEY), F.col(c))
    hidden = lambda c: protect.decrypt(c, DEMO_KEY).isNotNull()
    out = h.select(
        "CustomerID", shown("FirstName").alias("FirstName"), shown("Email").alias("Email"), shown("Phone").alias("Phone"),
        "City", "LoyaltyTier", hidden("FirstName").alias("FirstNameProtected"), hidden("Email").alias("EmailProtected"),
        "SnapshotDate", "FileName").where(odd > 0)
    # the raw ids in quarantine are those of the rows that have none
    bad = _history(spark, f"{root}/bronze/quarantine/insurance_customer").where(F.col("column") == "CustomerID")
    ids = bad.select(F.col("value").alias("RejectedID"), F.substring("value", 2, 30).alias("_id"))
    mail = F.regexp_extract("Email", r"\.(\d+)@", 1)
    return (out.withColumn("_id", F.when(F.col("CustomerID").isNull(), mail)).join(ids, "_id", "left").drop("_id"))


@register("scan_mixed_formats", """
SELECT * REPLACE (CASE SnapshotDate
                    WHEN '2024-01-01' THEN 'policies_master_2024-01-01.parquet'
                    WHEN '2024-02-01' THEN 'policies_master_2024-02-01.json'
                    ELSE FileName END AS FileName)
FROM bronze_policies""")
def _scan_mixed(w: Warehouse) -> DataFrame:
    """A3, A4, A5: the policy extracts land as parquet, multi-line JSON
    arrays and CSV; one ingest reads each format and unions by name."""
    spark = w.spark
    root = scratch_path(spark, "mixed-formats")
    d1, d2, d3 = SNAPSHOT_DATES
    _land(w.bronze_policies, d1).write.parquet(f"{root}/landing/policies_master_{d1}.parquet")
    bronze.write_json_arrays(_land(w.bronze_policies, d2),
                             f"{root}/landing/policies_master_{d2}.json")
    (_land(w.bronze_policies, d3).write.option("header", True)
     .csv(f"{root}/landing/policies_master_{d3}.csv"))
    bronze.ingest(spark, f"{root}/landing", f"{root}/bronze", bronze.config_frame(spark),
                  DEMO_KEY, "india")
    return _history(spark, f"{root}/bronze/policies_master").select(*POLICY_FIXTURE_COLS)


@register("bronze_append_evolve", """
SELECT PolicyNumber, CustomerID, PolicyType, PaymentFrequency, AgentID,
       CASE WHEN SnapshotDate = '2024-01-01' THEN NULL ELSE AgentName END AS AgentName,
       CoverageAmount_INR, AnnualPremium_INR, PolicyStartDate, PolicyEndDate,
       _src_country, SnapshotDate, FileName
FROM bronze_policies""")
def _append_evolve(w: Warehouse) -> DataFrame:
    """B1 + W4: the first extract lacks AgentName; later ones add it.
    Appending by snapshot and reading with mergeSchema gives NULL for the
    column in older rows.  Re-running a snapshot replaces it (idempotent)."""
    spark = w.spark
    path = scratch_path(spark, "evolve") + "/policies_master"
    b = w.bronze_policies
    provenance.append_partitioned(
        b.where(F.col("SnapshotDate") == SNAPSHOT_DATES[0]).drop("AgentName"), path)
    later = b.where(F.col("SnapshotDate") != SNAPSHOT_DATES[0])
    provenance.append_partitioned(later, path)
    provenance.append_partitioned(later, path)  # same snapshots again: no duplicates
    return _history(spark, path).select(*POLICY_FIXTURE_COLS)


# Fixed routing rows for the routing check: the standard ones, an inactive
# row and a shorter overlapping pattern
ROUTING_CHECK_ROWS = bronze.CONFIG_ROWS + [
    ("policies", "policies_legacy", "", "N"),
    ("policy", "policy_misc", " PolicyNumber , ,", "Y"),
]
FEEDS = ("insurance_customer", "policies_master", "policy_claims", "policy_payments",
         "unknown_feed", "INSURANCE_CUSTOMER")
EXTS = ("csv", "json", "parquet", "XLSX")


def _pages_files(w: Warehouse) -> DataFrame:
    p = w.t.pages.select("page_id", "url")
    feed = F.element_at(F.array(*[F.lit(x) for x in FEEDS]),
                        (F.col("page_id") % len(FEEDS) + 1).cast("int"))
    ext = F.element_at(F.array(*[F.lit(x) for x in EXTS]),
                       (F.col("page_id") % len(EXTS) + 1).cast("int"))
    host = F.regexp_extract("url", r"//([^/]+)", 1)
    name = F.concat(feed, F.lit("_"), host, F.lit("."), ext)
    return p.select(F.col("page_id").alias("path"), name.alias("file_name"))


@register("route_files_theta_join", """
WITH files AS (
  SELECT page_id AS path,
         (['insurance_customer','policies_master','policy_claims','policy_payments',
           'unknown_feed','INSURANCE_CUSTOMER'])[page_id % 6 + 1] || '_' ||
         regexp_extract(url, '//([^/]+)', 1) || '.' ||
         (['csv','json','parquet','XLSX'])[page_id % 4 + 1] AS file_name
  FROM pages),
cfg(file_pattern, table_name, sensitive_cols, active_flag) AS (VALUES
  ('insurance_customer', 'insurance_customer', 'FirstName,LastName,Email,Phone', 'Y'),
  ('policies_master', 'policies_master', '', 'Y'),
  ('policy_claims', 'policy_claims', '', 'Y'),
  ('policy_payments', 'policy_payments', '', 'Y'),
  ('policies', 'policies_legacy', '', 'N'),
  ('policy', 'policy_misc', ' PolicyNumber , ,', 'Y')),
hits AS (
  SELECT f.path, c.table_name, c.sensitive_cols,
         ROW_NUMBER() OVER (PARTITION BY f.path ORDER BY length(c.file_pattern) DESC,
                            c.table_name) AS rk
  FROM files f JOIN cfg c ON c.active_flag = 'Y' AND contains(f.file_name, c.file_pattern))
SELECT f.path, f.file_name, h.table_name,
       CASE WHEN h.table_name IS NOT NULL THEN array_to_string(list_filter(
         list_transform(string_split(coalesce(h.sensitive_cols, ''), ','), lambda x: trim(x)),
         lambda x: x <> ''), ',') END AS sensitive_norm
FROM files f LEFT JOIN hits h ON h.path = f.path AND h.rk = 1""")
def _route(w: Warehouse) -> DataFrame:
    """Route file names (built from page URLs) to tables."""
    cfg = bronze.config_frame(w.spark, ROUTING_CHECK_ROWS)
    r = routing.route_files(_pages_files(w), cfg)
    return r.select("path", "file_name", "table_name",
                    F.array_join("sensitive_list", ",").alias("sensitive_norm"))


@register("route_files_equi_fallback", """
WITH files AS (
  SELECT page_id AS path,
         (['insurance_customer','policies_master','policy_claims','policy_payments',
           'unknown_feed','INSURANCE_CUSTOMER'])[page_id % 6 + 1] || '_' ||
         regexp_extract(url, '//([^/]+)', 1) || '.' ||
         (['csv','json','parquet','XLSX'])[page_id % 4 + 1] AS file_name
  FROM pages),
cfg(file_pattern, table_name, sensitive_cols, active_flag) AS (VALUES
  ('insurance_customer', 'insurance_customer', 'FirstName,LastName,Email,Phone', 'Y'),
  ('policies_master', 'policies_master', '', 'Y'),
  ('policy_claims', 'policy_claims', '', 'Y'),
  ('policy_payments', 'policy_payments', '', 'Y'),
  ('policies', 'policies_legacy', '', 'N'),
  ('policy', 'policy_misc', ' PolicyNumber , ,', 'Y')),
hits AS (
  SELECT f.path, c.table_name,
         ROW_NUMBER() OVER (PARTITION BY f.path ORDER BY length(c.file_pattern) DESC,
                            c.table_name) AS rk
  FROM files f JOIN cfg c ON c.active_flag = 'Y' AND contains(f.file_name, c.file_pattern))
SELECT f.path, h.table_name FROM files f LEFT JOIN hits h ON h.path = f.path AND h.rk = 1""")
def _route_equi(w: Warehouse) -> DataFrame:
    """J8 with a large config (a row per document that matches nothing): the
    same plan, the same answer."""
    many = w.t.documents.select(F.concat(F.lit("no_such_feed_"), "doc_id").alias("file_pattern"),
                                F.lit("nothing").alias("table_name"), F.lit("").alias("sensitive_cols"),
                                F.lit("Y").alias("active_flag"))
    cfg = bronze.config_frame(w.spark, ROUTING_CHECK_ROWS).unionByName(many)
    return routing.route_files(_pages_files(w), cfg).select("path", "table_name")


# ================================================================= streaming


EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                "value double, props string")
NTZ_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _land_events_by_day(w: Warehouse, landing: str) -> None:
    ev = w.t.events.withColumn("day", F.to_date("ts").cast("string"))
    (ev.repartition("day").write.partitionBy("day").option("header", True)
     .option("timestampNTZFormat", NTZ_MICROS).csv(landing))


@register("stream_ingest_archive", """
SELECT event_id, ts, user_id, event_type, value, props, 'UnitedKingdom' AS _src_country,
       strftime(ts, '%Y-%m-%d') AS SnapshotDate
FROM events""")
def _stream_ingest(w: Warehouse) -> DataFrame:
    """ST1 + B7: events land as one folder per day; the file stream ingests
    each file exactly once (run twice: the second run adds nothing and
    archives the files the first run committed)."""
    spark = w.spark
    root = scratch_path(spark, "stream-ingest")
    _land_events_by_day(w, f"{root}/landing")
    for _ in range(2):
        stream_jobs.ingest_stream(spark, f"{root}/landing", f"{root}/bronze",
                                  f"{root}/checkpoint", EVENT_SCHEMA + ", day string",
                                  "unitedkingdom", archive_dir=f"{root}/archive")
    out = spark.read.parquet(f"{root}/bronze")
    return out.select("event_id", "ts", "user_id", "event_type", "value", "props",
                      "_src_country", F.col("SnapshotDate").cast("string").alias("SnapshotDate"))


@register("stream_latest_per_key", """
SELECT * FROM silver_policies""")
def _stream_latest(w: Warehouse) -> DataFrame:
    """ST2: the three policy extracts arrive in as many runs of the stream, the
    last one twice on its day under two names; the streaming state keeps the
    latest row per policy, ties by file name; after the casts and fills the
    result equals the batch silver job in every column."""
    spark = w.spark
    root = scratch_path(spark, "stream-latest")

    def enrich(src: DataFrame) -> DataFrame:
        return src.withColumns({
            "_src_country": F.lit("India"),
            "SnapshotDate": provenance.snapshot_from_name(F.col("_metadata.file_path")),
            "FileName": F.regexp_extract("_metadata.file_path", r"(policies_[^/]+\.csv)/", 1),
        })

    last = SNAPSHOT_DATES[-1]
    for d in SNAPSHOT_DATES:
        rows = _land(w.bronze_policies, d)
        rows.write.option("header", True).csv(f"{root}/landing/policies_master_{d}.csv")
        if d == last:       # the same day under a name that sorts before: never wins
            (rows.withColumn("AgentName", F.lit("earlier file")).write.option("header", True)
             .csv(f"{root}/landing/policies_first_{d}.csv"))
        stream_jobs.latest_state_stream(
            spark, f"{root}/landing", f"{root}/changelog", f"{root}/checkpoint",
            bronze.TABLE_SCHEMAS["policies_master"], "PolicyNumber",
            [parse_date("SnapshotDate"), F.col("FileName")], enrich=enrich)
    latest = stream_jobs.read_latest(spark, f"{root}/changelog", "PolicyNumber")
    typed = silver.fill_policy_defaults(silver.type_policies(latest))
    return gold.money_as_double(typed).select(*POLICY_FIXTURE_COLS)


@register("stream_windowed_totals", """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type,
       COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, value FROM events)
GROUP BY window_start, event_type""")
def _stream_windows(w: Warehouse) -> DataFrame:
    """ST3: hourly event counts and value totals per type, watermark 10
    minutes, every window published, open ones too: the batch answer."""
    spark = w.spark
    root = scratch_path(spark, "stream-windows")
    _land_events_by_day(w, f"{root}/landing")
    stream_jobs.windowed_totals_stream(
        spark, f"{root}/landing", f"{root}/sink", f"{root}/checkpoint",
        EVENT_SCHEMA + ", day string", "ts", "event_type", "value")
    return stream_jobs.read_windows(spark, f"{root}/sink", "event_type")


# ============================================================ more sources



@register("scan_workbooks", """
SELECT * REPLACE (replace(FileName, '.csv', '.xlsx') AS FileName) FROM bronze_customers""")
def _scan_workbooks(w: Warehouse) -> DataFrame:
    """A2: the customer extracts land as folders of .xlsx workbooks; the
    ingest reads them (binaryFile + per-task unzip/XML), encrypts, stamps."""
    spark = w.spark
    root = scratch_path(spark, "workbooks")
    for d in SNAPSHOT_DATES:
        workbooks.write_xlsx(_land(w.bronze_customers, d),
                             f"{root}/landing/insurance_customer_{d}.xlsx")
    bronze.ingest(spark, f"{root}/landing", f"{root}/bronze", bronze.config_frame(spark),
                  DEMO_KEY, "india")
    hist = _history(spark, f"{root}/bronze/insurance_customer")
    plain = protect.unprotect_columns(hist, CUSTOMER_PII, DEMO_KEY, strict=True)
    return plain.select(*CUSTOMER_FIXTURE_COLS)


@register("json_flatten_struct", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _json_flatten(w: Warehouse) -> DataFrame:
    """A JSON text column parsed to a struct and flattened to columns."""
    ev = w.t.events.select("event_id", "event_type",
                           F.from_json("props", "k bigint").alias("props"))
    return ev.select("event_id", "event_type", "props.*")


# ============================================================ SQL on tables

@register("sql_kpi_claims_summary", """
SELECT COUNT(ClaimID) AS TotalClaims,
       CAST(SUM(ClaimAmount_INR) AS DOUBLE) AS ClaimedAmount,
       CAST(SUM(SettledAmount_INR) AS DOUBLE) AS SettledAmount
FROM fact_claims""")
def _sql_claims_summary(w: Warehouse) -> DataFrame:
    """A6 + B3/B4: the layers published as catalog tables; the claims
    summary written as SQL against ``gold.fact_claims``."""
    w.published.register_catalog()
    return w.spark.sql("""
        SELECT COUNT(ClaimID) AS TotalClaims,
               CAST(SUM(ClaimAmount_INR) AS DOUBLE) AS ClaimedAmount,
               CAST(SUM(SettledAmount_INR) AS DOUBLE) AS SettledAmount
        FROM gold.fact_claims""")


@register("sql_kpi_agent_performance", """
SELECT AgentID, AgentName, COUNT(*) AS PoliciesSold,
       CAST(SUM(AnnualPremium_INR) AS DOUBLE) AS TotalPremium
FROM policies GROUP BY AgentID, AgentName""")
def _sql_agent_performance(w: Warehouse) -> DataFrame:
    """Agent performance as SQL against ``silver.policies``."""
    w.published.register_catalog()
    return w.spark.sql("""
        SELECT AgentID, AgentName, COUNT(*) AS PoliciesSold,
               CAST(SUM(AnnualPremium_INR) AS DOUBLE) AS TotalPremium
        FROM silver.policies GROUP BY AgentID, AgentName""")


@register("sql_fact_payments_star", """
SELECT p.TransactionID, dc.CustomerKey, CAST(p.Amount_INR AS DOUBLE) AS Amount_INR, p.PaidDate
FROM payments p JOIN dim_customer dc ON p.CustomerID = dc.CustomerID AND dc.IsCurrent = true""")
def _sql_fact_payments(w: Warehouse) -> DataFrame:
    """F3 as a SQL star join over the catalog tables (J1: current row in ON)."""
    w.published.register_catalog()
    return w.spark.sql("""
        SELECT p.TransactionID, dc.CustomerKey, CAST(p.Amount_INR AS DOUBLE) AS Amount_INR,
               p.PaidDate
        FROM silver.payments p
        JOIN gold.dim_customer dc ON p.CustomerID = dc.CustomerID AND dc.IsCurrent = true""")


# ============================================================ layer run



def _layer_bronze(w: Warehouse) -> str:
    """Land every entity's extracts as CSV and ingest them, as a daily run
    would (once per warehouse); the root of its layers."""
    root = w.__dict__.get("_layer_root")
    if root is not None:
        return root
    spark = w.spark
    root = scratch_path(spark, "layers")
    land = f"{root}/landing"
    feeds = {
        "insurance_customer": w.bronze_customers.drop("_src_country", "FileName"),
        "policies_master": w.bronze_policies.drop("_src_country", "FileName"),
        "vehicle_master": _views.bronze_vehicles(w.t).drop("_src_country", "FileName"),
        "policy_claims": _views.redelivered(_views.keyed_claims(w.t), "ClaimID", "SettledAmount_INR"),
        "policy_payments": _views.redelivered(_views.keyed_payments(w.t), "TransactionID", "Amount_INR"),
    }
    with ThreadPoolExecutor(max_workers=4) as pool:                  # independent jobs
        list(pool.map(lambda f: bronze.land_csv(f[1], land, F.concat(F.lit(f"{f[0]}_"), "SnapshotDate", F.lit(".csv")),
                                                "SnapshotDate"), feeds.items()))
    bronze.ingest(spark, land, f"{root}/bronze", bronze.config_frame(spark), DEMO_KEY, "india")
    w.__dict__["_layer_root"] = root
    return root


def _layer_silver(w: Warehouse) -> str:
    """The silver layer of the run and its counts (once per warehouse)."""
    root = _layer_bronze(w)
    if not w.__dict__.get("_layer_silver"):
        layers.run_silver(w.spark, f"{root}/bronze", f"{root}/silver", DEMO_KEY, audit=f"{root}/audit", run="day")
        w.__dict__["_layer_silver"] = True
    return root


def _layer_run(w: Warehouse) -> layers.Gold:
    """Landed extracts -> bronze -> silver -> gold over files."""
    run = w.__dict__.get("_layer_run")
    if run is None:
        root = _layer_silver(w)
        run = w.__dict__["_layer_run"] = layers.run_gold(w.spark, f"{root}/silver", f"{root}/gold")
    return run


@register("layers_dim_customer", "SELECT * FROM dim_customer_scd2")
def _layers_dim(w: Warehouse) -> DataFrame:
    """Landed files -> bronze -> silver -> gold: the customer dimension
    (SCD2 over the silver customer snapshots) equals the direct build."""
    return _layer_run(w).dim_customer.select(*SCD2_COLUMNS)


@register("layers_kpi_premium_by_policy_type", """
SELECT PolicyType, COUNT(*) AS PolicyCount,
       CAST(SUM(AnnualPremium_INR) AS DOUBLE) AS TotalPremium
FROM layer_fact_policy GROUP BY PolicyType""")
def _layers_k2(w: Warehouse) -> DataFrame:
    """K2 on the layer run's policy fact (deduplicated, filled silver
    policies on the SCD2 customer dimension)."""
    return kpis.premium_by_policy_type(_layer_run(w).fact_policy)


@register("layers_kpi_loss_ratio_overall_as_written", """
SELECT CAST(SUM(fc.SettledAmount_INR) AS DOUBLE)
       / NULLIF(CAST(SUM(fp.AnnualPremium_INR) AS DOUBLE), 0) AS LossRatio
FROM layer_fact_claims fc JOIN layer_fact_policy fp ON fc.CustomerKey = fp.CustomerKey""")
def _layers_k4(w: Warehouse) -> DataFrame:
    """K4 as written on the layer run's facts."""
    g = _layer_run(w)
    return kpis.loss_ratio_overall_as_written(g.fact_claims, g.fact_policy)


@register("layers_payments_collection", """
SELECT COUNT(p.TransactionID) AS TotalPayments,
       CAST(SUM(p.Amount_INR) AS DOUBLE) AS TotalCollected,
       CAST(SUM(p.Amount_INR) AS DOUBLE) / NULLIF(COUNT(p.Amount_INR), 0) AS AvgPayment
FROM layer_payments p JOIN dim_customer_scd2 dc ON p.CustomerID = dc.CustomerID AND dc.IsCurrent""")
def _layers_k12(w: Warehouse) -> DataFrame:
    """K12 on the layer run's payment fact."""
    return kpis.payment_collection(_layer_run(w).fact_payments)


@register("layers_kpi_claims_summary", """
SELECT COUNT(ClaimID) AS TotalClaims, CAST(SUM(SettledAmount_INR) AS DOUBLE) AS SettledAmount FROM layer_fact_claims""")
def _layers_k3(w: Warehouse) -> DataFrame:
    """K3 on the layer run's claim fact: three overlapping deliveries do not
    inflate it (D15)."""
    return kpis.claims_summary(_layer_run(w).fact_claims).drop("ClaimedAmount")


@register("layers_claims_as_written", """
SELECT CAST(SUM(1 + CAST(ClaimID % 3 = 0 AS INT) + CAST(ClaimID % 7 = 0 AS INT)) AS BIGINT) AS DeliveredRows,
       COUNT(*) AS Claims,
       CAST(SUM(SettledAmount_INR * (1 + 2 * CAST(ClaimID % 3 = 0 AS INT) + CAST(ClaimID % 7 = 0 AS INT))) AS DOUBLE)
         AS SettledAmount
FROM keyed_claims""")
def _layers_as_written(w: Warehouse) -> DataFrame:
    """L3 as written: every delivered row with an id stays."""
    root = _layer_bronze(w)
    layers.run_silver(w.spark, f"{root}/bronze", f"{root}/silver-as-written", DEMO_KEY, as_written=True, tables=["claims"])
    df = layers.read_silver(w.spark, f"{root}/silver-as-written", "claims")
    return df.agg(F.count(F.lit(1)).alias("DeliveredRows"), F.countDistinct("ClaimID").alias("Claims"),
                  F.sum("SettledAmount_INR").cast("double").alias("SettledAmount"))


ORACLE_AUDIT_SILVER = """
WITH c AS (SELECT count(*) AS n, count(*) FILTER (ClaimID % 3 = 0) AS a, count(*) FILTER (ClaimID % 7 = 0) AS b,
                  count(*) FILTER (ClaimID % 11 = 0) AS q FROM keyed_claims),
     p AS (SELECT count(*) AS n, count(*) FILTER (TransactionID % 3 = 0) AS a,
                  count(*) FILTER (TransactionID % 7 = 0) AS b, count(*) FILTER (TransactionID % 11 = 0) AS q FROM keyed_payments)
SELECT 'customers' AS table_name, count(*) AS rows_in, count(*) AS rows_out, 0 AS rows_quarantined, 0 AS rows_superseded FROM bronze_customers
UNION ALL SELECT 'policies', count(*), count(DISTINCT PolicyNumber), 0, count(*) - count(DISTINCT PolicyNumber) FROM bronze_policies
UNION ALL SELECT 'vehicles', count(*), count(*), 0, 0 FROM bronze_vehicles
UNION ALL SELECT 'claims', n + a + b + q, n, q, a + b FROM c
UNION ALL SELECT 'payments', n + a + b + q, n, q, a + b FROM p"""


@register("audit_silver_rows", ORACLE_AUDIT_SILVER)
def _audit_silver(w: Warehouse) -> DataFrame:
    """Per silver table rows in = rows out + quarantined + superseded."""
    root = _layer_silver(w)
    return layers.audit_silver(w.spark, f"{root}/bronze", f"{root}/silver")


@register("audit_observed", ORACLE_AUDIT_SILVER)
def _audit_observed(w: Warehouse) -> DataFrame:
    """Q5: the same from the counts that the silver writes took."""
    root = _layer_silver(w)
    return layers.audit_observed(w.spark, f"{root}/audit", "day")


@register("kpi_tables_by_name", """
SELECT PolicyType, COUNT(*) AS PolicyCount, CAST(SUM(AnnualPremium_INR) AS DOUBLE) AS TotalPremium
FROM fact_policy GROUP BY PolicyType""")
def _kpi_tables(w: Warehouse) -> DataFrame:
    """The KPIs created, and created again, as catalog tables; one read
    back by name."""
    g = w.gold
    tables = layers.kpi_tables(g.fact_policy, g.fact_claims, g.fact_payments, g.dim_customer, g.dim_vehicle,
                               w.policies_with_agent)
    root = scratch_path(w.spark, "kpi-tables")
    some = {k: tables[k] for k in ("kpi_premium_by_policy_type", "kpi_claims_summary")}
    for _ in range(2):
        layers.publish_kpis(w.spark, some, "kpi", root)
    return w.spark.table("kpi.kpi_premium_by_policy_type")


@register("parse_hire_date", """
SELECT event_id, upper(strftime(ts, '%d-%b-%y')) AS HireText, CAST(ts AS DATE) AS HireDate FROM events""")
def _hire_date(w: Warehouse) -> DataFrame:
    """Dates written like 21-JUN-07."""
    text_form = F.upper(F.date_format("ts", "dd-MMM-yy"))
    return w.t.events.select("event_id", text_form.alias("HireText"),
                             parse_date(F.initcap(F.lower(text_form)), "dd-MMM-yy").alias("HireDate"))


# ====================================================== incremental KPIs



@register("kpi_payment_collection_incremental", """
SELECT COUNT(TransactionID) AS TotalPayments,
       CAST(SUM(Amount_INR) AS DOUBLE) AS TotalCollected,
       CAST(SUM(Amount_INR) AS DOUBLE) / NULLIF(COUNT(Amount_INR), 0) AS AvgPayment
FROM fact_payments""")
def _k12_incremental(w: Warehouse) -> DataFrame:
    """K12 maintained from per-delivery state.  Payments arrive as one
    delivery per paid year (unpaid ones as delivery 0); each delivery is
    folded into the state on its own (one is folded twice: idempotent), and
    the KPI is read from the merged state."""
    spark = w.spark
    path = scratch_path(spark, "kpi-state") + "/payment_collection"
    rows = w.gold.fact_payments.select("Amount_INR", F.col("TransactionID").isNotNull().cast("int").alias("_has_id"),
                                       F.coalesce(F.year("PaidDate"), F.lit(0)).alias("_year"))
    # one aggregate keyed by delivery, one partitioned write for all that came
    state = incremental.partial_state(rows, [], ["Amount_INR", "_has_id"], "_year")
    incremental.fold(state, path)
    # the unpaid ones are delivered again: their state is replaced
    again = rows.where(F.col("_year") == 0)
    incremental.fold(incremental.partial_state(again, [], ["Amount_INR", "_has_id"], "_year"), path)
    t = incremental.read_totals(spark, path, [], ["Amount_INR", "_has_id"])
    return t.select(F.col("sum__has_id").cast("bigint").alias("TotalPayments"),
                    F.col("sum_Amount_INR").cast("double").alias("TotalCollected"),
                    F.try_divide(F.col("sum_Amount_INR").cast("double"),
                                 F.col("count_Amount_INR")).alias("AvgPayment"))
