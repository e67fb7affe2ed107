"""KPIs of the full history, kept up to date by delivery.

A daily gold refresh of the reference recomputes every KPI.  These fold the
day's delivery into a written state instead and read the KPI from it:

* loss ratios and claim frequency (K4, K5, K13) over ``operators.pair_state``:
  a claim or policy that a later delivery supersedes is taken back;
* distinct counts (K1, K6) over ``operators.distinct_state``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.distinct_state import DistinctState
from ..operators.pair_state import AMOUNT, PairState
from .kpis import _dbl, _ratio
from .silver import POLICY_DEFAULTS


def _side(rows: DataFrame, id_col: str, key: str, amount: Column, grp: Column | None = None) -> DataFrame:
    return rows.select(F.col(id_col).alias("id"), F.col(key).alias("k"), amount.alias("amount"),
                       F.col("SnapshotDate").alias("version"), *([grp.alias("grp")] if grp is not None else []))


def fold_loss_ratio(state: PairState, run: int, claims: DataFrame | None, policies: DataFrame | None,
                    key: str, group: str | None = None) -> None:
    """Claims on the left, policies on the right, joined on ``key`` (K4 on
    CustomerKey, K13 on VehicleKey with the make as ``group``)."""
    left = None if claims is None else _side(claims, "ClaimID", key, F.col("SettledAmount_INR").try_cast(AMOUNT),
                                             F.col(group) if group else None)
    right = None if policies is None else _side(policies, "PolicyNumber", key,
                                                F.coalesce(F.col("AnnualPremium_INR").try_cast(AMOUNT), F.lit(0)))
    state.fold(run, left, right)


def loss_ratio(state: PairState, group: str | None = None) -> DataFrame:
    """K4 / K13 as written, from the totals."""
    t = state.totals().where("pairs > 0")
    ratio = _ratio(F.sum("left_over_pairs"), F.sum("right_over_pairs")).alias("LossRatio")
    return t.groupBy(F.col("grp").alias(group)).agg(ratio) if group else t.agg(ratio)


def fold_claim_frequency(state: PairState, run: int, policies: DataFrame | None, claims: DataFrame | None) -> None:
    """K5: policies by type on the left, claims on the right, on VehicleKey."""
    left = None if policies is None else _side(
        policies, "PolicyNumber", "VehicleKey", F.lit(0), F.coalesce("PolicyType", F.lit(POLICY_DEFAULTS["PolicyType"])))
    right = None if claims is None else _side(claims, "ClaimID", "VehicleKey", F.lit(0))
    state.fold(run, left, right)


def claim_frequency(state: PairState) -> DataFrame:
    """K5 from the totals: claims over distinct vehicles, by policy type."""
    return state.totals().select(F.col("grp").alias("PolicyType"),
                                 F.try_divide(_dbl(F.col("pairs")), _dbl(F.col("keys"))).alias("ClaimFrequency"))


PLACE = ("City", "State", "Country")


def fold_customers(state: DistinctState, run: int, customers: DataFrame) -> None:
    """K6: customers by place, moving with their latest snapshot."""
    state.fold(run, customers.select(F.col("CustomerID").alias("key"), F.col("SnapshotDate").alias("version"),
                                     F.to_json(F.struct(*PLACE)).alias("grp")))


def customer_distribution(state: DistinctState) -> DataFrame:
    """K6 from the bitmaps."""
    place = F.from_json("grp", ", ".join(f"{c} string" for c in PLACE))
    return state.counts().select(place.alias("p"), "keys").select("p.*", F.col("keys").alias("CustomerCount"))
