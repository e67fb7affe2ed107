"""Insurance entities as views over the driver's TPC-H-style tables.

The reference reads silver/gold tables of an insurance company; the test
data is TPC-H-shaped.  These builders map one onto the other (the mapping is
documented in FIXTURES.md section 3).  Every builder is a lazy DataFrame over
the parquet scans, so its work grows with the tables.

Money is ``decimal(18,2)`` of the stored 2-decimal column, which keeps sums
exact and engine-independent; results are cast to double at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables

MONEY = "decimal(18,2)"

# Fixed values of the test mapping (FIXTURES.md section 3).  The modulo
# rules below define the fixture's *content* -- which policies insure a
# vehicle, which customers moved, which snapshot re-delivers a policy --
# they never sample: every row of the source tables is read and used.
COVERAGE_MULTIPLE = 20          # CoverageAmount = 20 x premium
POLICY_TERM_DAYS = 365          # PolicyEndDate = start + 365 days
CLAIM_SETTLE_DAYS = 30          # SettlementDate = ClaimDate + 30 days
VEHICLE_KEY_OFFSET = 1_000_000  # VehicleKey = order key + 1,000,000
UNPAID_LINE = 7                 # payment lines with this number are unpaid
SNAPSHOT_DATES = ("2024-01-01", "2024-02-01", "2024-03-01")
SOURCE_COUNTRY = "India"


def money(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def _row_count(df: DataFrame) -> Column:
    """Scalar-subquery row count: stays inside the plan, no driver round trip."""
    return df.select(F.count(F.lit(1))).scalar()


# ---------------------------------------------------------------- policies

def policies_core(t: Tables) -> DataFrame:
    """Policies without the agent lookup (what the facts need)."""
    start = F.to_date("o_orderdate")
    premium = money("o_totalprice")
    return t.orders.select(
        F.col("o_orderkey").alias("PolicyNumber"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderpriority").alias("PolicyType"),
        F.col("o_orderstatus").alias("PaymentFrequency"),
        premium.alias("AnnualPremium_INR"),
        (premium * COVERAGE_MULTIPLE).cast(MONEY).alias("CoverageAmount_INR"),
        start.alias("PolicyStartDate"),
        F.date_add(start, POLICY_TERM_DAYS).alias("PolicyEndDate"),
    )


def policies(t: Tables) -> DataFrame:
    """Policies with the selling agent (supplier picked by order key)."""
    sup = t.supplier
    agents = sup.select(
        F.col("s_suppkey").alias("AgentID"), F.col("s_name").alias("AgentName"))
    pol = policies_core(t).withColumn(
        "_agent", F.col("PolicyNumber") % _row_count(sup))
    return (pol.join(agents, pol["_agent"] == agents["AgentID"], "left")
               .drop("_agent"))


# ------------------------------------------------------------ claims/payments

def claims(t: Tables) -> DataFrame:
    """Returned line items are claims against their order's policy."""
    li = t.lineitem.where(F.col("l_returnflag") == "R")
    o = t.orders.select("o_orderkey", "o_custkey")
    amount = money("l_extendedprice")
    claim_date = F.to_date("l_shipdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ClaimID"),
        F.col("l_orderkey").alias("PolicyNumber"),
        F.col("o_custkey").alias("CustomerID"),
        claim_date.alias("ClaimDate"),
        F.date_add(claim_date, CLAIM_SETTLE_DAYS).alias("SettlementDate"),
        amount.alias("ClaimAmount_INR"),
        (amount * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
        .alias("SettledAmount_INR"),
    )


def payments(t: Tables) -> DataFrame:
    """Finished line items are premium instalments; line 7 is never paid."""
    li = t.lineitem.where(F.col("l_linestatus") == "F")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("TransactionID"),
        F.col("o_custkey").alias("CustomerID"),
        money("l_extendedprice").alias("Amount_INR"),
        F.to_date("o_orderdate").alias("ScheduledDate"),
        F.when(F.col("l_linenumber") != UNPAID_LINE, F.to_date("l_shipdate"))
         .alias("PaidDate"),
    )


# ------------------------------------------------------------- dimensions

def customer_geo(t: Tables) -> DataFrame:
    """Customer with nation and region names (nation/region: 25/5 rows)."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
             .join(r, F.col("n_regionkey") == r["r_regionkey"], "left"))


def dim_customer(t: Tables) -> DataFrame:
    """Simple two-version customer dimension used by the facts.

    Current row: key 2*id+1.  Every fifth customer also has a closed row
    (key 2*id, City 'OLD').  One scan of customer; ``inline`` emits one or
    two rows per customer.
    """
    g = customer_geo(t)
    cur = F.struct(
        (F.col("c_custkey") * 2 + 1).alias("CustomerKey"),
        F.col("c_mktsegment").alias("City"),
        F.lit(True).alias("IsCurrent"))
    old = F.struct(
        (F.col("c_custkey") * 2).alias("CustomerKey"),
        F.lit("OLD").alias("City"),
        F.lit(False).alias("IsCurrent"))
    versions = F.when(F.col("c_custkey") % 5 == 0, F.array(cur, old)) \
                .otherwise(F.array(cur))
    return g.select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("n_name").alias("State"),
        F.col("r_name").alias("Country"),
        F.inline(versions),
    ).select("CustomerKey", "CustomerID", "City", "State", "Country", "IsCurrent")


def dim_vehicle(t: Tables) -> DataFrame:
    """One insured vehicle per policy whose number is not a multiple of 4."""
    part = t.part
    makes = part.select(F.col("p_partkey"), F.col("p_brand").alias("VehicleMake"))
    o = (t.orders.select("o_orderkey")
         .where(F.col("o_orderkey") % 4 != 0)
         .withColumn("_part", F.col("o_orderkey") % _row_count(part)))
    return o.join(makes, o["_part"] == makes["p_partkey"], "left").select(
        (F.col("o_orderkey") + VEHICLE_KEY_OFFSET).alias("VehicleKey"),
        F.col("o_orderkey").alias("PolicyNumber"),
        F.col("VehicleMake"),
        F.lit(True).alias("IsCurrent"),
    )


# ------------------------------------------------------- bronze snapshots

def _snapshot_rows(base: DataFrame, feed: str, versions: list[Column],
                   fields: list[str]) -> DataFrame:
    """One scan of ``base``; each row emits one row per non-NULL struct in
    ``versions`` (a snapshot it appears in), stamped like a landed file."""
    keep = [c for c in base.columns if c not in fields]
    out = base.select(*keep, F.inline(F.array_compact(F.array(*versions))))
    out = out.withColumns({
        "_src_country": F.lit(SOURCE_COUNTRY),
        "FileName": F.concat(F.lit(f"{feed}_"), F.col("SnapshotDate"), F.lit(".csv")),
    })
    return out


def bronze_policies(t: Tables) -> DataFrame:
    """Three daily extracts of the policy master, as landed text.

    1st: every policy.  2nd: policy number divisible by 3, premium doubled.
    3rd: divisible by 7, PolicyType and premium missing.
    """
    p = policies(t)
    as_text = lambda c: F.col(c).cast("string")
    base = p.select(
        "PolicyNumber", "CustomerID", "PolicyType", "PaymentFrequency",
        "AgentID", "AgentName",
        as_text("CoverageAmount_INR").alias("CoverageAmount_INR"),
        F.col("AnnualPremium_INR").alias("_premium"),
        as_text("PolicyStartDate").alias("PolicyStartDate"),
        as_text("PolicyEndDate").alias("PolicyEndDate"),
    )
    key = F.col("PolicyNumber")

    def version(snapshot: str, ptype: Column, premium: Column) -> Column:
        return F.struct(ptype.alias("PolicyType"), premium.alias("AnnualPremium_INR"),
                        F.lit(snapshot).alias("SnapshotDate"))

    versions = [
        version(SNAPSHOT_DATES[0], F.col("PolicyType"), F.col("_premium").cast("string")),
        F.when(key % 3 == 0, version(SNAPSHOT_DATES[1], F.col("PolicyType"),
                                     (F.col("_premium") * 2).cast(MONEY).cast("string"))),
        F.when(key % 7 == 0, version(SNAPSHOT_DATES[2], F.lit(None).cast("string"),
                                     F.lit(None).cast("string"))),
    ]
    out = _snapshot_rows(base, "policies_master", versions, ["PolicyType", "_premium"])
    return out.select("PolicyNumber", "CustomerID", "PolicyType", "PaymentFrequency",
                      "AgentID", "AgentName", "CoverageAmount_INR", "AnnualPremium_INR",
                      "PolicyStartDate", "PolicyEndDate", "_src_country", "SnapshotDate",
                      "FileName")


def bronze_customers(t: Tables) -> DataFrame:
    """Three daily customer extracts with dirty DOB/Age text.

    1st: all customers.  2nd: all, City 'MOVED' for every fifth customer.
    3rd: even customer ids, unchanged since the 2nd.
    """
    g = customer_geo(t)
    key = F.col("c_custkey")
    dob = F.date_add(F.lit("1950-01-01").cast("date"),
                     ((key * 37) % 18000).cast("int")).cast("string")
    base = g.select(
        key.alias("CustomerID"),
        F.col("c_name").alias("FirstName"),
        F.concat(F.lit("Family"), (key % 100).cast("string")).alias("LastName"),
        F.concat(F.lit("User."), key.cast("string"), F.lit("@Example.COM")).alias("Email"),
        F.concat(F.lit("+91-(020) "), key.cast("string")).alias("Phone"),
        F.when(key % 97 == 0, F.lit("31/12/2020")).otherwise(dob).alias("DOB"),
        F.when(key % 89 == 0, F.lit("n/a"))
         .otherwise((key % 60 + 18).cast("string")).alias("Age"),
        F.col("c_mktsegment").alias("_segment"),
        F.col("n_name").alias("State"),
        F.col("r_name").alias("Country"),
    )
    cid = F.col("CustomerID")
    moved = F.when(cid % 5 == 0, F.lit("MOVED")).otherwise(F.col("_segment"))

    def version(snapshot: str, city: Column) -> Column:
        return F.struct(city.alias("City"), F.lit(snapshot).alias("SnapshotDate"))

    versions = [
        version(SNAPSHOT_DATES[0], F.col("_segment")),
        version(SNAPSHOT_DATES[1], moved),
        F.when(cid % 2 == 0, version(SNAPSHOT_DATES[2], moved)),
    ]
    out = _snapshot_rows(base, "insurance_customer", versions, ["_segment"])
    return out.select("CustomerID", "FirstName", "LastName", "Email", "Phone", "DOB", "Age",
                      "City", "State", "Country", "_src_country", "SnapshotDate", "FileName")


def bronze_vehicles(t: Tables) -> DataFrame:
    """Three vehicle extracts.  1st: the vehicle of every insured policy.
    2nd: make 'REPLACED' for policy numbers divisible by 6.  3rd: odd numbers,
    unchanged since the 1st."""
    v = dim_vehicle(t).select("PolicyNumber", F.col("VehicleMake").alias("_make"))
    key = F.col("PolicyNumber")

    def version(snapshot: str, make: Column) -> Column:
        return F.struct(make.alias("VehicleMake"), F.lit(snapshot).alias("SnapshotDate"))

    versions = [
        version(SNAPSHOT_DATES[0], F.col("_make")),
        F.when(key % 6 == 0, version(SNAPSHOT_DATES[1], F.lit("REPLACED"))),
        F.when(key % 2 == 1, version(SNAPSHOT_DATES[2], F.col("_make"))),
    ]
    out = _snapshot_rows(v, "vehicle_master", versions, ["_make"])
    return out.select("PolicyNumber", "VehicleMake", "_src_country", "SnapshotDate", "FileName")


def keyed_claims(t: Tables) -> DataFrame:
    """Claims with an id that is theirs alone (several returned lines of an
    order can share a line number): digits of a hash of the line."""
    c = claims(t)
    return c.withColumn("ClaimID", _own_id(c, "ClaimID", "ClaimDate", "ClaimAmount_INR"))


def keyed_payments(t: Tables) -> DataFrame:
    """Payments with an id that is theirs alone."""
    p = payments(t)
    return p.withColumn("TransactionID", _own_id(p, "TransactionID", "PaidDate", "Amount_INR"))


def _own_id(df: DataFrame, *cols: str) -> Column:
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def redelivered(rows: DataFrame, key: str, amount: str) -> DataFrame:
    """Three overlapping deliveries.  1st: every row.  2nd: ids divisible by
    3, amount doubled.  3rd: ids divisible by 7, as in the 1st.  Ids divisible
    by 11 also come without an id in the 1st."""
    k, value = F.col(key), F.col(amount)

    def version(snapshot: str, id_col: Column, v: Column) -> Column:
        return F.struct(id_col.alias(key), v.cast("string").alias(amount), F.lit(snapshot).alias("SnapshotDate"))

    versions = [
        version(SNAPSHOT_DATES[0], k, value),
        F.when(k % 3 == 0, version(SNAPSHOT_DATES[1], k, value * 2)),
        F.when(k % 7 == 0, version(SNAPSHOT_DATES[2], k, value)),
        F.when(k % 11 == 0, version(SNAPSHOT_DATES[0], F.lit(None).cast("bigint"), value)),
    ]
    rest = [F.col(c).cast("string").alias(c) if c.endswith("Date") or c.endswith("_INR") else F.col(c)
            for c in rows.columns if c not in (key, amount)]
    return rows.select(*rest, F.inline(F.array_compact(F.array(*versions))))


def bronze_claims(t: Tables) -> DataFrame:
    """Claims as landed text (dates and amounts as strings)."""
    c = claims(t)
    return c.select(
        "ClaimID", "CustomerID", "PolicyNumber",
        *[F.col(x).cast("string").alias(x) for x in
          ("ClaimDate", "SettlementDate", "ClaimAmount_INR", "SettledAmount_INR")])


def bronze_payments(t: Tables) -> DataFrame:
    """Payments as landed text (dates and amounts as strings)."""
    p = payments(t)
    return p.select(
        "TransactionID", "CustomerID",
        *[F.col(x).cast("string").alias(x) for x in
          ("ScheduledDate", "PaidDate", "Amount_INR")])


def call_notes(t: Tables) -> DataFrame:
    """A free-text note per policy, with its customer's names in several
    spellings, and words that only look like names."""
    p, c = policies_core(t).select("PolicyNumber", "CustomerID"), t.customer.select("c_custkey", "c_name")
    last = F.concat(F.lit("Family"), (F.col("CustomerID") % 100).cast("string"))
    other = F.concat(F.lit("Family"), (F.col("PolicyNumber") % 130).cast("string"))
    number = F.col("PolicyNumber").cast("string")
    note = F.concat(F.lit("Spoke to "), "c_name", F.lit(" "), last, F.lit(" on policy "), number, F.lit(". "), F.upper(last),
                    F.lit("'s car, not "), last, F.lit("x nor x"), last, F.lit("; cc "), F.lower("c_name"), F.lit(","), other,
                    F.lit("/"), last, F.lit(" é"), other)
    return p.join(c, p["CustomerID"] == c["c_custkey"]).select("PolicyNumber", note.alias("note"))
