"""Checked queries of the jobs that keep a state by delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import inference, names, quality, sketches, variants
from ..operators.bucket_state import BucketState
from ..operators.distinct_state import DistinctState
from ..operators.pair_state import PairState
from ..operators.scd2_buckets import BucketDimension, rekey
from ..session import scratch_path
from ..sources import views
from ..sources.files import read_csv
from ..sources.json_split import read_json_split
from ..sources.views import SNAPSHOT_DATES
from . import gold, kpi_state, layers
from .bronze import write_json_arrays
from .catalog import SCD2_COLUMNS, _customer_snapshots, register
from .warehouse import Warehouse

FIRST, SECOND, THIRD = SNAPSHOT_DATES


def _day(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("SnapshotDate") == day)


def _deliveries(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """(claims, policies): the three overlapping deliveries, as landed, with
    the keys of the current dimension rows."""
    customer = gold.current(w.dim_customer, "CustomerID", "CustomerKey")
    vehicle = gold.current(w.dim_vehicle, "PolicyNumber", "VehicleKey", "VehicleMake")
    claims = views.redelivered(views.keyed_claims(w.t), "ClaimID", "SettledAmount_INR")
    keyed = lambda df: df.join(vehicle, "PolicyNumber", "left").join(customer, "CustomerID")
    by_day = lambda name, df: _by_day(w.spark, keyed(df).drop("CustomerID"), name)
    return (by_day("claims", claims.where("ClaimID IS NOT NULL").select(
                "ClaimID", "PolicyNumber", "CustomerID", "SettledAmount_INR", "SnapshotDate")),
            by_day("policies", w.bronze_policies.select("PolicyNumber", "CustomerID", "PolicyType", "AnnualPremium_INR", "SnapshotDate")))


def _by_day(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The deliveries, keyed once and kept by day: each fold reads its own."""
    path = scratch_path(spark, name)
    df.write.partitionBy("SnapshotDate").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folded(w: Warehouse, fold, name: str) -> PairState:
    """The three deliveries folded in, the second twice, claims and policies
    of a day in one run or apart."""
    state = PairState(w.spark, scratch_path(w.spark, name), buckets=8)
    claims, policies = _deliveries(w)
    fold(state, 1, _day(claims, FIRST), _day(policies, FIRST))
    fold(state, 2, _day(claims, SECOND), None)
    fold(state, 3, _day(claims, SECOND), _day(policies, SECOND))
    fold(state, 4, _day(claims, THIRD), _day(policies, THIRD))
    return state


# what the three deliveries leave: the latest of every claim, as in the layers
LATEST_CLAIMS = """
SELECT * REPLACE (SettledAmount_INR * CASE WHEN ClaimID % 7 <> 0 AND ClaimID % 3 = 0 THEN 2 ELSE 1 END AS SettledAmount_INR)
FROM keyed_claims"""


@register("kpi_loss_ratio_overall_incremental", f"""
SELECT CAST(SUM(c.SettledAmount_INR) AS DOUBLE) / NULLIF(CAST(SUM(p.AnnualPremium_INR) AS DOUBLE), 0) AS LossRatio
FROM ({LATEST_CLAIMS}) c JOIN silver_policies p ON p.CustomerID = c.CustomerID""")
def _k4_state(w: Warehouse) -> DataFrame:
    """K4 as written from the pair state over overlapping deliveries."""
    state = _folded(w, lambda s, run, c, p: kpi_state.fold_loss_ratio(s, run, c, p, "CustomerKey"), "loss-ratio")
    return kpi_state.loss_ratio(state)


@register("kpi_loss_ratio_incremental", f"""
SELECT v.VehicleMake, CAST(SUM(c.SettledAmount_INR) AS DOUBLE)
       / NULLIF(CAST(SUM(p.AnnualPremium_INR) AS DOUBLE), 0) AS LossRatio
FROM ({LATEST_CLAIMS}) c JOIN dim_vehicle v ON v.PolicyNumber = c.PolicyNumber
JOIN silver_policies p ON p.PolicyNumber = v.PolicyNumber GROUP BY v.VehicleMake""")
def _k13_state(w: Warehouse) -> DataFrame:
    """K13 as written, by make, from the pair state."""
    state = _folded(w, lambda s, run, c, p: kpi_state.fold_loss_ratio(s, run, c, p, "VehicleKey", "VehicleMake"), "loss-by-make")
    return kpi_state.loss_ratio(state, "VehicleMake")


@register("kpi_claim_frequency_incremental", f"""
SELECT p.PolicyType, CAST(COUNT(c.ClaimID) AS DOUBLE) / NULLIF(COUNT(DISTINCT v.VehicleKey), 0) AS ClaimFrequency
FROM silver_policies p LEFT JOIN dim_vehicle v ON v.PolicyNumber = p.PolicyNumber
LEFT JOIN ({LATEST_CLAIMS}) c ON c.PolicyNumber = v.PolicyNumber GROUP BY p.PolicyType""")
def _k5_state(w: Warehouse) -> DataFrame:
    """K5 from the pair state; a policy that changes its type moves with
    its vehicle and claims."""
    state = _folded(w, lambda s, run, c, p: kpi_state.fold_claim_frequency(s, run, p, c), "frequency")
    return kpi_state.claim_frequency(state)


@register("kpi_customer_distribution_incremental", """
SELECT City, State, Country, COUNT(DISTINCT CustomerKey) AS CustomerCount
FROM dim_customer_scd2 WHERE IsCurrent GROUP BY City, State, Country""")
def _k6_state(w: Warehouse) -> DataFrame:
    """K6 from bitmaps over the three customer snapshots, one twice, in
    which customers move."""
    state = DistinctState(w.spark, scratch_path(w.spark, "customers"), moving=True, buckets=8)
    for run, day in enumerate((FIRST, SECOND, SECOND, THIRD), 1):
        kpi_state.fold_customers(state, run, _day(w.bronze_customers, day))
    return kpi_state.customer_distribution(state)


@register("distinct_policies_incremental", """
SELECT PolicyType, COUNT(DISTINCT PolicyNumber) AS Policies, FALSE AS AllTypes FROM bronze_policies GROUP BY PolicyType
UNION ALL SELECT NULL, COUNT(DISTINCT PolicyNumber), TRUE FROM bronze_policies""")
def _policies_state(w: Warehouse) -> DataFrame:
    """Distinct policies ever delivered, by type and of all types (a
    policy of two types counts once), from bitmaps merged by OR."""
    state = DistinctState(w.spark, scratch_path(w.spark, "policies"), buckets=8)
    for run, day in enumerate((FIRST, SECOND, SECOND, THIRD), 1):
        rows = _day(w.bronze_policies, day)
        state.fold(run, rows.select(F.col("PolicyNumber").alias("key"), F.col("PolicyType").alias("grp")))
    by_type = state.counts().select(F.col("grp").alias("PolicyType"), F.col("keys").alias("Policies"), F.lit(False).alias("AllTypes"))
    all_types = state.counts(F.lit(None).cast("string")).select(
        F.col("grp").alias("PolicyType"), F.col("keys").alias("Policies"), F.lit(True).alias("AllTypes"))
    return by_type.unionByName(all_types)


# ================================================== profile, types, dimension

PROFILED = ("PolicyNumber", "CustomerID", "PolicyType", "PaymentFrequency", "AgentID", "AgentName", "CoverageAmount_INR",
            "AnnualPremium_INR", "PolicyStartDate", "PolicyEndDate", "_src_country", "SnapshotDate", "FileName")
MONEY_COLUMNS = ("CoverageAmount_INR", "AnnualPremium_INR")


@register("dq_profile_sketched", f"""
WITH bp AS (SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in PROFILED)} FROM bronze_policies),
     l AS (SELECT * FROM bp UNPIVOT INCLUDE NULLS (value FOR column_name IN ({', '.join(PROFILED)})))
SELECT column_name, COUNT(*) AS row_count, COUNT(*) - COUNT(value) AS null_count, TRUE AS distinct_within,
       CASE WHEN column_name IN {MONEY_COLUMNS} THEN TRUE END AS quantiles_within, TRUE AS frequent_found
FROM l GROUP BY column_name""")
def _profile_sketched(w: Warehouse) -> DataFrame:
    """Q1 from sketch states of three deliveries, one folded twice; estimates
    are held against exact counts here and must keep the stated errors."""
    path = scratch_path(w.spark, "profile")
    rows = w.bronze_policies.select(*PROFILED)
    state = sketches.profile_state(rows, "SnapshotDate", numeric=MONEY_COLUMNS)
    sketches.fold(state, path)
    sketches.fold(state.where(F.col("_delivery") == SECOND), path)
    got = sketches.merged(w.spark, path)
    exact = quality.profile(rows).select("column_name", F.col("distinct_count").alias("exact"))
    # ranks of the estimated quantiles, and the values that really are frequent, per column
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in PROFILED])
    long = rows.select(F.inline(cells)).where("value IS NOT NULL")
    number = F.col("value").try_cast("double")
    asked = got.select("column_name", "quantiles").where("quantiles IS NOT NULL")
    ranks = long.join(asked, "column_name").groupBy("column_name").agg(F.array(*[
        F.avg((number <= F.get("quantiles", F.lit(i))).cast("double")) for i in range(3)]).alias("ranks"))
    often = (long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
             .join(got.select("column_name", "row_count"), "column_name").where(F.col("n") >= F.col("row_count") * sketches.FREQUENT)
             .groupBy("column_name").agg(F.collect_set("value").alias("often")))
    near = lambda i, q: F.abs(F.get("ranks", F.lit(i)) - q) <= sketches.RANK_ERROR
    items = F.transform("frequent", lambda x: x["item"])
    return (got.join(exact, "column_name").join(ranks, "column_name", "left").join(often, "column_name", "left")
            .select("column_name", "row_count", "null_count",
                    (F.abs(F.col("distinct_count") - F.col("exact")) <= F.col("exact") * sketches.DISTINCT_ERROR + 1)
                    .alias("distinct_within"),
                    F.when(F.col("quantiles").isNotNull(), near(0, 0.05) & near(1, 0.5) & near(2, 0.95)).alias("quantiles_within"),
                    (F.size(F.array_except(F.coalesce("often", F.array().cast("array<string>")), items)) == 0)
                    .alias("frequent_found")))


@register("scan_csv_inferred", """
SELECT PolicyNumber, CustomerID, CAST(AnnualPremium_INR AS DOUBLE) AS AnnualPremium_INR, CAST(PolicyStartDate AS TIMESTAMP) AS Start,
       PolicyEndDate, CAST(PolicyNumber AS VARCHAR) AS Code, PolicyNumber % 2 = 0 AS Flag, NULL AS Region FROM policies
UNION ALL
SELECT PolicyNumber, CustomerID, CAST(PolicyNumber AS DOUBLE), CAST(PolicyStartDate AS TIMESTAMP) + INTERVAL 90 MINUTE,
       PolicyEndDate, 'P-' || PolicyNumber, PolicyNumber % 2 = 1, PaymentFrequency FROM policies""")
def _scan_inferred(w: Warehouse) -> DataFrame:
    """A1: two CSV deliveries whose texts disagree on types: whole and
    fractional amounts, dates and times, numbers and codes, a new column."""
    root = scratch_path(w.spark, "inferred")
    p = w.policies
    one = p.select("PolicyNumber", "CustomerID", F.col("AnnualPremium_INR").alias("Premium"), F.col("PolicyStartDate").alias("Start"),
                   "PolicyEndDate", F.col("PolicyNumber").alias("Code"), (F.col("PolicyNumber") % 2 == 0).alias("Flag"))
    later = F.expr("CAST(PolicyStartDate AS TIMESTAMP) + INTERVAL '90' MINUTE")
    two = p.select("PolicyNumber", "CustomerID", F.col("PolicyNumber").alias("Premium"),
                   F.date_format(later, "yyyy-MM-dd HH:mm:ss").alias("Start"), "PolicyEndDate",
                   F.concat(F.lit("P-"), F.col("PolicyNumber").cast("string")).alias("Code"),
                   (F.col("PolicyNumber") % 2 == 1).alias("Flag"), F.col("PaymentFrequency").alias("Region"))
    for name, df in (("one", one), ("two", two)):
        df.write.option("header", True).csv(f"{root}/{name}.csv")
    read = {name: read_csv(w.spark, [f"{root}/{name}.csv"]) for name in ("one", "two")}
    inference.scan_inferred(w.spark, {"one": read["one"]}, f"{root}/facts")
    out = inference.scan_inferred(w.spark, read, f"{root}/facts")
    return out.select("PolicyNumber", "CustomerID", F.col("Premium").cast("double").alias("AnnualPremium_INR"),
                      F.col("Start").cast("timestamp_ntz").alias("Start"), "PolicyEndDate", "Code", "Flag", "Region")


def _merged_customers(w: Warehouse) -> tuple[BucketDimension, list[DataFrame]]:
    """The customer dimension after three snapshots, one merged twice, and the
    change feeds of the runs."""
    dim = BucketDimension(w.spark, scratch_path(w.spark, "dim-buckets"), "CustomerID", layers.CUSTOMER_ATTRS, "CustomerKey",
                          buckets=8)
    rows = _customer_snapshots(w)
    feeds = []
    for run, day in enumerate((FIRST, SECOND, SECOND, THIRD), 1):
        dim.merge(run, rows.where(F.col("SnapshotDate") == F.lit(day).cast("date")), "SnapshotDate", [F.col("FileName").desc()])
        feeds.append(dim.changes.read_run(run))
    return dim, feeds


@register("dim_customer_bucket_merge", "SELECT * FROM dim_customer_scd2")
def _dim_buckets(w: Warehouse) -> DataFrame:
    """M4 by touched buckets: equals the rebuild."""
    return _merged_customers(w)[0].read().select(*SCD2_COLUMNS)


@register("fact_policy_rekeyed", """
SELECT p.PolicyNumber, p.CustomerID, d.CustomerKey, CAST(p.AnnualPremium_INR AS DOUBLE) AS AnnualPremium_INR
FROM policies p JOIN dim_customer_scd2 d ON d.CustomerID = p.CustomerID AND d.IsCurrent""")
def _fact_rekeyed(w: Warehouse) -> DataFrame:
    """F1 kept: policies keyed once, then re-keyed by the change feeds of the
    dimension's merges only."""
    dim, feeds = _merged_customers(w)
    facts = BucketState(w.spark, scratch_path(w.spark, "fact-buckets"),
                        "PolicyNumber bigint, CustomerID bigint, CustomerKey bigint, AnnualPremium_INR decimal(18,2)", 8)
    policies = w.policies.select("PolicyNumber", "CustomerID", F.lit(None).cast("bigint").alias("CustomerKey"),
                                 F.col("AnnualPremium_INR"))
    spread = [F.pmod(F.xxhash64("PolicyNumber"), F.lit(4))]
    # the first feed holds every customer: it keys the facts that come with it
    first = policies.join(feeds[0].select("CustomerID", "new_key"), "CustomerID").withColumn("CustomerKey", F.col("new_key"))
    rekey(facts, feeds[0].limit(0), 1, "CustomerID", "CustomerKey", new_facts=first.drop("new_key"), spread=spread)
    for run, feed in enumerate(feeds[1:], 2):
        rekey(facts, feed, run, "CustomerID", "CustomerKey", spread=spread)
    return facts.read().select("PolicyNumber", "CustomerID", "CustomerKey", F.col("AnnualPremium_INR").cast("double"))


# ============================================================ names in texts

@register("mask_names_text", """
WITH names AS (SELECT DISTINCT lower(unnest([FirstName, LastName, FirstName || ' ' || LastName])) AS name FROM bronze_customers),
     words AS (SELECT PolicyNumber, note, lower(note) AS low FROM call_notes),
     -- every name against every note; a position counts where no letter or digit touches it
     hits AS (SELECT PolicyNumber, low, name FROM words JOIN names ON contains(low, name)),
     spans AS (SELECT PolicyNumber, p AS a, p + length(name) AS b
               FROM (SELECT PolicyNumber, low, name, unnest(range(1, length(low) - length(name) + 2)) AS p FROM hits)
               WHERE substr(low, p, length(name)) = name AND NOT regexp_full_match(substr(' ' || low, p, 1), '[a-z0-9]')
                 AND NOT regexp_full_match(substr(low || ' ', p + length(name), 1), '[a-z0-9]')),
     kept AS (SELECT * FROM spans s WHERE NOT EXISTS (SELECT 1 FROM spans o WHERE o.PolicyNumber = s.PolicyNumber
                AND o.a <= s.a AND o.b >= s.b AND (o.a < s.a OR o.b > s.b))),
     parts AS (SELECT PolicyNumber, a, b, lag(b, 1, 1) OVER (PARTITION BY PolicyNumber ORDER BY a) AS before FROM kept),
     masked AS (SELECT PolicyNumber, count(*) AS n, string_agg(substr(note, before::BIGINT, (a - before)::BIGINT) || '<NAME>', '' ORDER BY a)
                       || substr(any_value(note), max(b)::BIGINT) AS t
                FROM parts JOIN words USING (PolicyNumber) GROUP BY PolicyNumber)
SELECT w.PolicyNumber, CAST(coalesce(m.n, 0) AS INTEGER) AS n_names, coalesce(m.t, w.note) AS masked_text
FROM words w LEFT JOIN masked m USING (PolicyNumber)""")
def _mask_names(w: Warehouse) -> DataFrame:
    """Q7: the customers' first, last and full names masked in call notes."""
    people = names.name_list(w.bronze_customers, "FirstName", "LastName")
    return names.mask_names(views.call_notes(w.t), "note", people).drop("note")


# ============================================================ large JSON files

@register("scan_json_split", """
SELECT event_id, ts, user_id, event_type, value, props, '{"a": "}\\"{' || event_id AS tricky FROM events""")
def _scan_json_split(w: Warehouse) -> DataFrame:
    """A3: all events landed as large multi-line JSON files, one for each task
    that writes, arrays of records with braces, quotes and escapes in their
    strings, each read by many tasks."""
    path = scratch_path(w.spark, "json")
    events = w.t.events.withColumns({"tricky": F.concat(F.lit('{"a": "}\\"{'), F.col("event_id").cast("string")),
                                     "ts": F.col("ts").cast("string")})
    write_json_arrays(events, path, rows_per_file=1 << 30)
    key = "spark.sql.files.maxPartitionBytes"
    before = w.spark.conf.get(key)
    w.spark.conf.set(key, "256k")              # test files are small: several splits all the same
    try:
        out = read_json_split(w.spark, [path], events.schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        return w.spark.read.schema(out.schema).parquet(_kept(out, f"{path}-read"))
    finally:
        w.spark.conf.set(key, before)


def _kept(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path


# ============================================================ changing records

@register("bronze_append_variant", """
SELECT event_id, DATE '2024-01-01' AS day, value AS amount, NULL AS kind, NULL AS first_tag, FALSE AS nested FROM events
UNION ALL
SELECT event_id, DATE '2024-02-01', value, event_type, 'u' || user_id, TRUE FROM events
UNION ALL SELECT NULL, DATE '2024-03-01', NULL, NULL, NULL, NULL""")
def _append_variant(w: Warehouse) -> DataFrame:
    """A field that is a number in one delivery and an object in the
    next, a new nested array, and a record that is no JSON: appended (one
    delivery twice), kept and queried by path."""
    path = scratch_path(w.spark, "variant")
    e = w.t.events
    text = lambda *c: F.to_json(F.struct(*c)).alias("value")
    one = e.select(text("event_id", F.col("value").alias("detail")))
    two = e.select(text("event_id", F.struct(F.col("event_type").alias("kind"), F.col("value").alias("amount"), F.array(
        F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("tags")).alias("detail")))
    bad = w.spark.range(1).select(F.lit('{"event_id": 1, "detail"').alias("value"))
    for day, rows in ((FIRST, one), (SECOND, two), (SECOND, two), (THIRD, bad)):
        variants.append_records(rows, path, "India", day, F.lit(f"events_{day}.json"))
    rows = variants.read_records(w.spark, path)
    got = variants.fields(rows, {
        "event_id": ("$.event_id", "bigint"), "plain": ("$.detail", "double"), "amount": ("$.detail.amount", "double"),
        "kind": ("$.detail.kind", "string"), "first_tag": ("$.detail.tags[0]", "string")}, "SnapshotDate", "unparsed")
    return got.select("event_id", F.col("SnapshotDate").cast("date").alias("day"), F.coalesce("amount", "plain").alias("amount"),
                      "kind", "first_tag", F.when(F.col("unparsed").isNull(), F.col("kind").isNotNull()).alias("nested"))
