"""Bronze: route landed deliveries to tables, read, protect, stamp, append.

A *delivery* is what lands directly under the landing folder: a file, or a
folder of part files (what Spark and most exporters write).  Its name drives
routing (contains-pattern match), its extension picks the reader, and a
``yyyy-MM-dd`` inside it is the snapshot date (else the run date, which is
required then).

Per run: one distributed listing and one routing join; only one row per
delivery reaches the driver.  Deliveries of a table that agree in format,
columns and sensitive list are read and written together; each keeps its own
route's sensitive list.  Columns are found by name (``quality.harmonize``):
reordered and renamed ones land where they belong, unknown ones are kept, and
history evolves with them.  Values that fail the declared type are NULL in the
table and reported in ``quarantine/<table>``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..functions.protect import protect_columns
from ..functions.text import country_name
from ..operators.bucket_state import _fs, path_exists
from ..operators.observed import Counted
from ..operators.provenance import META_COLS, append_partitioned, snapshot_from_name, stamp
from ..operators.quality import harmonize
from ..operators.routing import route_files
from ..session import scratch_path
from ..sources.files import READERS, csv_header, source_path

CONFIG_SCHEMA = "file_pattern string, table_name string, sensitive_cols string, active_flag string"

# Fixed routing rows: the reference's two, plus claims and payments, which
# its silver layer reads but no row routed (D14); one name per entity.
CONFIG_ROWS = [
    ("insurance_customer", "insurance_customer", "FirstName,LastName,Email,Phone", "Y"),
    ("policies_master", "policies_master", "", "Y"),
    ("policy_claims", "policy_claims", "", "Y"),
    ("policy_payments", "policy_payments", "", "Y"),
    ("vehicle_master", "vehicle_master", "", "Y"),
]

# Declared bronze schemas (D9): ids typed, everything else landed as text
TABLE_SCHEMAS = {
    "insurance_customer": (
        "CustomerID bigint, FirstName string, LastName string, Email string, "
        "Phone string, DOB string, Age string, City string, State string, Country string"),
    "policies_master": (
        "PolicyNumber bigint, CustomerID bigint, PolicyType string, PaymentFrequency string, "
        "AgentID bigint, AgentName string, CoverageAmount_INR string, "
        "AnnualPremium_INR string, PolicyStartDate string, PolicyEndDate string"),
    "policy_claims": (
        "ClaimID bigint, CustomerID bigint, PolicyNumber bigint, ClaimDate string, "
        "SettlementDate string, ClaimAmount_INR string, SettledAmount_INR string"),
    "policy_payments": (
        "TransactionID bigint, CustomerID bigint, ScheduledDate string, PaidDate string, "
        "Amount_INR string"),
    "vehicle_master": "PolicyNumber bigint, VehicleMake string",
}

# Fixed alias map: column names of country feeds -> the common names
COLUMN_ALIASES = {
    "policy_number": "PolicyNumber", "customer_id": "CustomerID",
    "policy_type": "PolicyType", "payment_frequency": "PaymentFrequency",
    "annual_premium": "AnnualPremium_INR", "coverage_amount": "CoverageAmount_INR",
    "start_date": "PolicyStartDate", "first_name": "FirstName", "last_name": "LastName",
    "mail": "Email", "e_mail": "Email", "phone_number": "Phone",
}


def config_frame(spark: SparkSession, rows: Sequence[tuple] = tuple(CONFIG_ROWS)) -> DataFrame:
    """The routing config as a DataFrame."""
    return spark.createDataFrame(list(rows), CONFIG_SCHEMA)


_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _delivery_of(path: Column, landing: str) -> Column:
    """First path segment below the landing folder (its full path, so that a
    folder of the same name elsewhere in the path does not matter)."""
    base = re.sub(_SCHEME, "", landing).rstrip("/") + "/"
    plain = F.regexp_replace(path, _SCHEME, "")
    return F.split(F.substring(plain, len(base) + 1, 1 << 30), "/")[0]


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """Every landed file with its delivery name and format."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(landing).select("path"))
    delivery = _delivery_of(F.col("path"), landing)
    return files.select(
        "path", delivery.alias("delivery"),
        F.lower(F.regexp_extract(delivery, r"\.([A-Za-z0-9]+)$", 1)).alias("format"))


def ingest(spark: SparkSession, landing: str, bronze_root: str, config: DataFrame,
           key: str, country: str, run_date: str | None = None,
           schemas: dict[str, str] | None = None, mode: str = "ECB",
           aliases: Mapping[str, str] = COLUMN_ALIASES) -> DataFrame:
    """Route, read, protect, stamp and append every landed delivery.

    Returns the routing report, one row per file with ``status``: files that
    no active pattern matches are ``unrouted``, those of a format without a
    reader ``unknown format``; neither stops the others (D11)."""
    schemas = schemas or TABLE_SCHEMAS
    files = landed(spark, landing)
    routed = route_files(files.select("delivery", "format").distinct(), config,
                         name_col="delivery", id_col="delivery")
    plan = (routed.where(F.col("table_name").isNotNull() & F.col("format").isin(*READERS))
            .select("delivery", "format", "table_name", "sensitive_list").collect())

    def columns(r) -> tuple[str, ...]:
        return csv_header(spark, f"{landing}/{r['delivery']}") if r["format"] == "csv" else ()

    with ThreadPoolExecutor(max_workers=8) as pool:      # one line of each CSV delivery
        headers = list(pool.map(columns, plan))
    groups: dict[tuple, list[str]] = {}
    for r, header in zip(plan, headers):
        group = (r["table_name"], r["format"], tuple(sorted(r["sensitive_list"] or [])), header)
        groups.setdefault(group, []).append(f"{landing}/{r['delivery']}")

    def append(group: tuple) -> None:
        (table, fmt, sensitive, header), paths = group
        df = READERS[fmt](spark, sorted(paths), header) if fmt == "csv" else READERS[fmt](spark, sorted(paths))
        # file paths of rows are URI-encoded
        path = F.url_decode(F.replace(source_path(df), F.lit("+"), F.lit("%2B"))) if fmt != "xlsx" else source_path(df)
        df = df.withColumn("_delivery", _delivery_of(path, landing)).drop("_source_path")
        declared = schemas.get(table)
        target = {f.name: f.dataType.simpleString() for f in _parse_datatype_string(declared)} if declared else {}
        df = harmonize(df, aliases, target, keep_unknown=True)
        df = protect_columns(df, sensitive, key, mode)
        df = stamp(df, country_name(F.lit(country)),
                   snapshot_from_name("_delivery", run_date), F.col("_delivery"))
        # the write counts what it rejects; only a delivery with such values is read again
        counted = Counted()
        seen = counted.watch(df, "in", {"rejected": F.count(F.when(F.size("_rejected") > 0, F.lit(1)))})
        append_partitioned(seen.drop("_delivery", "_rejected"), f"{bronze_root}/{table}")
        quarantine = f"{bronze_root}/quarantine/{table}"
        if counted.values()["in"]["rejected"] or path_exists(spark, quarantine):
            rejected = df.select(*META_COLS, F.explode("_rejected").alias("r")).select(
                "r.column", F.when(~F.col("r.column").isin(*sensitive), F.col("r.value")).alias("value"), *META_COLS)
            append_partitioned(rejected, quarantine)

    # tables side by side; the groups of one table after another
    tables: dict[str, list[tuple]] = {}
    for group in sorted(groups.items()):
        tables.setdefault(group[0][0], []).append(group)
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda of_table: [append(g) for g in of_table], tables.values()))
    status = F.when(F.col("table_name").isNull(), "unrouted").when(
        ~F.col("format").isin(*READERS), "unknown format").otherwise("ingested")
    return files.select("path", "delivery").join(routed, "delivery").withColumn("status", status)


def land_csv(df: DataFrame, landing: str, delivery: Column, *drop: str) -> None:
    """Land the rows of several deliveries as CSV folders from one pass over
    ``df``: written apart, by the name of the delivery, then put in place."""
    spark = df.sparkSession
    staged = scratch_path(spark, "landing")
    (df.withColumn("_delivery", delivery).drop(*drop).write.partitionBy("_delivery")
     .option("header", True).option("compression", "gzip").csv(staged))
    fs, root = _fs(spark, staged)
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(at(landing))
    for s in fs.listStatus(root):
        if (name := s.getPath().getName()).startswith("_delivery="):
            if not fs.rename(s.getPath(), at(f"{landing}/{name.split('=', 1)[1]}")):
                raise OSError(f"{name} can't be put in {landing}")


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Land rows as multi-line JSON: each file holds one array of at most
    ``rows_per_file`` records, written a record to a line as they come (a
    writer task holds a batch of them, whatever the size of the file)."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    lines = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j"))

    def pack(batches):
        n = 0
        for pdf in batches:
            out: list[str] = []
            for j in pdf["j"]:
                out.append(("," if n % rows_per_file else "[") + j)
                n += 1
                if n % rows_per_file == 0:
                    out.append("]")
            yield pd.DataFrame({"value": out}, dtype=object)
        if n % rows_per_file:
            yield pd.DataFrame({"value": ["]"]})

    # a full file is its records and the closing line
    (lines.mapInPandas(pack, "value string").write
     .option("maxRecordsPerFile", rows_per_file + 1).mode("overwrite").text(path))
