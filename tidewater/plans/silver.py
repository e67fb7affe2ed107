"""Silver jobs: type, standardise and deduplicate the four entities (L1-L4).

Each job is ``DataFrame -> DataFrame`` over the bronze rows.  Differences
from the reference, all deliberate (SURVEY 1.6):

* D1: standardising happens on plain text; protection comes after.
* D4: the NULL fill is applied to the real columns, after the casts.
* D5: the dedup winner is deterministic; NULL-key rows go to quarantine
  (``layers.run_silver`` writes them).
* D7: money is decimal(18,2).
* D15: claims and payments too keep the latest delivery of each key
  (``latest_claims``, ``latest_payments``); ``clean_claims`` and
  ``clean_payments`` alone keep every delivered row, as written.
* D8: unparsable values become NULL (see ``quality.quarantine``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import parse_date, parse_int, parse_money
from ..functions.text import normalize_email, normalize_phone
from ..operators.dedup import latest_per_key

# Fixed fill values for missing policy fields
POLICY_DEFAULTS = {"CoverageAmount_INR": 0, "AnnualPremium_INR": 0, "PolicyType": "UNKNOWN"}


def clean_customers(bronze: DataFrame) -> DataFrame:
    """L1: DOB -> date, Age -> int, e-mail lower case, phone digits only."""
    return bronze.withColumns({
        "DOB": parse_date("DOB"),
        "Age": parse_int("Age"),
        "Email": normalize_email("Email"),
        "Phone": normalize_phone("Phone"),
    })


def latest_policies(bronze: DataFrame) -> DataFrame:
    """The newest snapshot of every policy (NULL snapshot never wins)."""
    keyed = bronze.where(F.col("PolicyNumber").isNotNull())
    return latest_per_key(
        keyed, ["PolicyNumber"],
        [parse_date("SnapshotDate").desc_nulls_last(), F.col("FileName").desc_nulls_last()])


def latest_delivery(bronze: DataFrame, key: str) -> DataFrame:
    """The newest delivered row of every key, as for policies."""
    return latest_per_key(
        bronze.where(F.col(key).isNotNull()), [key],
        [parse_date("SnapshotDate").desc_nulls_last(), F.col("FileName").desc_nulls_last()])


def latest_claims(bronze: DataFrame) -> DataFrame:
    """L3 on a history of overlapping deliveries."""
    return clean_claims(latest_delivery(bronze, "ClaimID"))


def latest_payments(bronze: DataFrame) -> DataFrame:
    """L4 on a history of overlapping deliveries."""
    return clean_payments(latest_delivery(bronze, "TransactionID"))


def type_policies(df: DataFrame) -> DataFrame:
    """Casts of the policy columns (dates and money)."""
    return df.withColumns({
        "SnapshotDate": parse_date("SnapshotDate"),
        "PolicyStartDate": parse_date("PolicyStartDate"),
        "PolicyEndDate": parse_date("PolicyEndDate"),
        "CoverageAmount_INR": parse_money("CoverageAmount_INR"),
        "AnnualPremium_INR": parse_money("AnnualPremium_INR"),
    })


def fill_policy_defaults(df: DataFrame) -> DataFrame:
    """NULL premium and coverage -> 0, NULL type -> 'UNKNOWN'."""
    return df.fillna(POLICY_DEFAULTS)


def clean_policies(bronze: DataFrame) -> DataFrame:
    """L2: dedup to the latest snapshot, type, then fill defaults."""
    return bronze.transform(latest_policies).transform(type_policies) \
                 .transform(fill_policy_defaults)


def clean_claims(bronze: DataFrame) -> DataFrame:
    """L3: two dates and two amounts."""
    return bronze.withColumns({
        "ClaimDate": parse_date("ClaimDate"),
        "SettlementDate": parse_date("SettlementDate"),
        "ClaimAmount_INR": parse_money("ClaimAmount_INR"),
        "SettledAmount_INR": F.col("SettledAmount_INR").try_cast("decimal(24,4)"),
    })


def late_flag(paid: str = "PaidDate", scheduled: str = "ScheduledDate"):
    """1 when paid after schedule.  An unpaid instalment (NULL PaidDate)
    compares as NULL and so counts as not late, as in the reference."""
    return F.when(F.col(paid) > F.col(scheduled), 1).otherwise(0)


def clean_payments(bronze: DataFrame) -> DataFrame:
    """L4: two dates, amount, late flag."""
    typed = bronze.withColumns({
        "ScheduledDate": parse_date("ScheduledDate"),
        "PaidDate": parse_date("PaidDate"),
        "Amount_INR": parse_money("Amount_INR"),
    })
    return typed.withColumn("IsLate", late_flag())


def overdue_flag(as_of: str, paid: str = "PaidDate", scheduled: str = "ScheduledDate"):
    """Variant of the late flag where an instalment still unpaid at ``as_of``
    and past its schedule counts as overdue."""
    return F.when(
        F.coalesce(F.col(paid), F.lit(as_of).cast("date")) > F.col(scheduled), 1
    ).otherwise(0)
