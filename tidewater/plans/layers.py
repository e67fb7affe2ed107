"""Layer runs over written tables: bronze history -> silver -> gold.

What a daily run of the reference does, as three calls over folders:

    bronze.ingest(spark, landing, f"{root}/bronze", config, key, country)
    run_silver(spark, f"{root}/bronze", f"{root}/silver", key)
    run_gold(spark, f"{root}/silver", f"{root}/gold")

Each step reads the previous layer's files and writes the next version of its
own (``operators.versioned``): a failed step is simply re-run, and readers keep
the version they have.  Rows are counted by the jobs that write them
(``operators.observed``).  Independent tables run side by side.  Nothing is
held on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import parse_date
from ..functions.protect import protect_columns, unprotect_columns
from ..operators import observed, scd2, versioned
from ..operators.provenance import read_history
from . import gold, kpis, silver

CUSTOMER_PII = ("FirstName", "LastName", "Email", "Phone")
CUSTOMER_ATTRS = ("City", "State", "Country")


def _exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path``?  Errors other than that are raised."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _customers(key: str, mode: str):
    def job(bronze: DataFrame) -> DataFrame:
        plain = unprotect_columns(bronze, CUSTOMER_PII, key, mode, strict=True)
        return protect_columns(silver.clean_customers(plain), CUSTOMER_PII, key, mode).withColumn(
            "SnapshotDate", parse_date("SnapshotDate"))
    return job


#: silver table -> (bronze table, business key, job as written).  Customers
#: and vehicles keep every snapshot: they are the input of the SCD2 builds.
SILVER_TABLES = {
    "customers": ("insurance_customer", "CustomerID"),
    "policies": ("policies_master", "PolicyNumber"),
    "claims": ("policy_claims", "ClaimID"),
    "payments": ("policy_payments", "TransactionID"),
    "vehicles": ("vehicle_master", "PolicyNumber"),
}


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, key: str,
               mode: str = "ECB", as_written: bool = False, audit: str | None = None, run: str = "",
               max_parallel: int = 4, tables: Sequence[str] = tuple(SILVER_TABLES)) -> dict[str, str]:
    """L1-L4 over the bronze history.  Customers keep every snapshot (the
    SCD2 input) and are standardised on plain text, then protected again
    (D1); policies, claims and payments keep the latest delivery of each key
    (W1, D15; with ``as_written`` claims and payments keep all).  Rows without
    a key go to ``quarantine/<table>`` (D5).  With ``audit`` the counts of the
    writes are kept there under ``run``.  ``tables`` names the ones to run, if
    not all.  Returns the written version of each table."""
    jobs = {
        "customers": _customers(key, mode),
        "policies": silver.clean_policies,
        "claims": silver.clean_claims if as_written else silver.latest_claims,
        "payments": silver.clean_payments if as_written else silver.latest_payments,
        "vehicles": lambda b: b.withColumn("SnapshotDate", parse_date("SnapshotDate")),
    }

    def one(table: str) -> tuple[str, str] | None:
        source, id_col = SILVER_TABLES[table]
        src = f"{bronze_root}/{source}"
        if not _exists(spark, src):
            return None
        bronze = read_history(spark, src)
        counted = observed.Counted()
        unkeyed = F.col(id_col).isNull()
        seen = counted.watch(bronze, "in", {"quarantined": F.count(F.when(unkeyed, F.lit(1)))})
        out = counted.watch(jobs[table](seen.where(~unkeyed)), "out")
        folder = versioned.replace(out, f"{silver_root}/{table}")
        n = counted.values()
        # files without such a row are skipped by their statistics
        versioned.replace(bronze.where(unkeyed).withColumn("reason", F.lit(f"no {id_col}")),
                          f"{silver_root}/quarantine/{table}")
        if audit:
            observed.record(spark, audit, run, "silver", table, {
                "rows_in": n["in"]["rows"], "rows_quarantined": n["in"]["quarantined"], "rows_out": n["out"]["rows"]})
        return table, folder

    with ThreadPoolExecutor(max_workers=max_parallel) as pool:      # independent jobs
        return dict(done for done in pool.map(one, tables) if done)


def read_silver(spark: SparkSession, silver_root: str, table: str) -> DataFrame:
    """The current version of a silver table (or ``quarantine/<table>``)."""
    return versioned.current(spark, f"{silver_root}/{table}")


def audit_observed(spark: SparkSession, audit: str, run: str) -> DataFrame:
    """Q5 from the counts that a run's writes took: the same rows as
    ``audit_silver``, without a scan of any layer."""
    t = (observed.recorded(spark, audit).where((F.col("run") == run) & (F.col("layer") == "silver"))
         .groupBy("table_name").pivot("metric", ["rows_in", "rows_out", "rows_quarantined"]).agg(F.first("value")))
    n = {c: F.col(c).cast("bigint") for c in ("rows_in", "rows_out", "rows_quarantined")}
    return t.select("table_name", *[v.alias(c) for c, v in n.items()],
                    (n["rows_in"] - n["rows_out"] - n["rows_quarantined"]).alias("rows_superseded"))


def audit_silver(spark: SparkSession, bronze_root: str, silver_root: str) -> DataFrame:
    """Q5 over written layers: per table the rows that came in, went out, were
    quarantined and were superseded by a later delivery of their key."""
    out = None
    for table, (source, id_col) in SILVER_TABLES.items():
        if not _exists(spark, f"{silver_root}/{table}"):
            continue
        history = read_history(spark, f"{bronze_root}/{source}")
        if table in ("customers", "vehicles"):           # every snapshot stays: nothing to look for
            row = spark.range(1).select(F.lit(table).alias("table_name"), F.lit(0).cast("bigint").alias("rows_superseded"))
        else:
            keyed = history.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
            row = keyed.agg(F.lit(table).alias("table_name"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_superseded"))
        count = lambda df: df.select(F.count(F.lit(1))).scalar()
        row = row.withColumns({
            "rows_in": count(history), "rows_out": count(read_silver(spark, silver_root, table)),
            "rows_quarantined": count(read_silver(spark, silver_root, f"quarantine/{table}"))})
        out = row if out is None else out.unionByName(row)
    return out.select("table_name", "rows_in", "rows_out", "rows_quarantined", "rows_superseded")


@dataclass
class Gold:
    dim_customer: DataFrame
    dim_vehicle: DataFrame
    fact_policy: DataFrame
    fact_claims: DataFrame
    fact_payments: DataFrame


def run_gold(spark: SparkSession, silver_root: str, gold_root: str) -> Gold:
    """M1 customer and vehicle dimensions from the silver snapshots, then
    F1-F3 on the written dimensions; every table written under ``gold_root``."""
    snapshots = {
        "dim_customer": ("customers", "CustomerID", CUSTOMER_ATTRS, "CustomerKey"),
        "dim_vehicle": ("vehicles", "PolicyNumber", ("VehicleMake",), "VehicleKey"),
    }
    dims = {name: scd2.build(read_silver(spark, silver_root, table), key, attrs, "SnapshotDate", key_name,
                             order=[F.col("FileName").desc()])
            for name, (table, key, attrs, key_name) in snapshots.items()}

    def write(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(max_workers=len(tables)) as pool:  # independent jobs
            folders = list(pool.map(lambda item: versioned.replace(item[1], f"{gold_root}/{item[0]}"), tables.items()))
        return {name: spark.read.parquet(folder) for name, folder in zip(tables, folders)}

    dc, dv = write(dims).values()
    facts = write({
        "fact_policy": gold.fact_policy(read_silver(spark, silver_root, "policies"), dc, dv),
        "fact_claims": gold.fact_claims(read_silver(spark, silver_root, "claims"), dc, dv),
        "fact_payments": gold.fact_payments(read_silver(spark, silver_root, "payments"), dc),
    })
    return Gold(dc, dv, **facts)


def kpi_tables(fact_policy: DataFrame, fact_claims: DataFrame, fact_payments: DataFrame,
               dim_customer: DataFrame, dim_vehicle: DataFrame,
               policies: DataFrame) -> dict[str, DataFrame]:
    """The gold KPI tables (K1-K13, both loss-ratio forms), lazily."""
    return {
        "kpi_portfolio_overview": kpis.portfolio_overview(fact_policy),
        "kpi_premium_by_policy_type": kpis.premium_by_policy_type(fact_policy),
        "kpi_claims_summary": kpis.claims_summary(fact_claims),
        "kpi_loss_ratio_overall_as_written": kpis.loss_ratio_overall_as_written(fact_claims, fact_policy),
        "kpi_loss_ratio_overall": kpis.loss_ratio_overall(fact_claims, fact_policy),
        "kpi_claim_frequency": kpis.claim_frequency(fact_policy, fact_claims),
        "kpi_customer_distribution": kpis.customer_distribution(dim_customer),
        "kpi_customer_claim_behavior": kpis.customer_claim_behavior(fact_claims, dim_customer),
        "kpi_payment_frequency_mix": kpis.payment_frequency_mix(policies),
        "kpi_policy_lifecycle": kpis.policy_lifecycle(fact_policy),
        "kpi_policy_expiring": kpis.policy_expiring(fact_policy),
        "kpi_agent_performance": kpis.agent_performance(policies),
        "kpi_avg_premium_per_customer": kpis.avg_premium_per_customer(fact_policy, dim_customer),
        "kpi_payment_collection": kpis.payment_collection(fact_payments),
        "kpi_loss_ratio_as_written": kpis.loss_ratio_by_make_as_written(fact_claims, fact_policy, dim_vehicle),
        "kpi_loss_ratio": kpis.loss_ratio_by_make(fact_claims, fact_policy, dim_vehicle),
    }


def publish_kpis(spark: SparkSession, tables: dict[str, DataFrame], database: str, out_root: str) -> list[str]:
    """Every KPI as a catalog table of ``database``, created or replaced."""
    from ..operators.catalog_tables import create_or_replace_table, ensure_database
    ensure_database(spark, database, f"{out_root}/{database}.db")
    for name, df in sorted(tables.items()):
        create_or_replace_table(spark, df, database, name, f"{out_root}/{name}")
    return sorted(tables)


def run_kpis(tables: dict[str, DataFrame], out_root: str, max_parallel: int = 4) -> dict[str, str]:
    """Write every KPI table (overwrite) under ``out_root``.

    The KPIs are independent Spark jobs over the same written facts; up to
    ``max_parallel`` of them are submitted at once from driver threads, so
    small KPI jobs share the cluster instead of queueing behind each other.
    Each write is an overwrite of its own folder: a failed run is re-run."""
    def write(item):
        name, df = item
        path = f"{out_root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return name, path

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return dict(pool.map(write, sorted(tables.items())))
