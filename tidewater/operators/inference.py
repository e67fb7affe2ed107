"""Column types inferred from text, and widened by later deliveries (A1, A2).

A column's type is the least type of a lattice that holds all its values:

    nothing  <  boolean                               <  text
             <  whole number  <  decimal  <  double   <  text
             <  date  <  timestamp                    <  text

What decides it is an aggregate of facts per column (how many values each type
would take, digits before and after the point), one pass over any number of
columns, a row each.  Facts of deliveries add up, so a type is that of all
deliveries so far and only ever widens; files need not be read again.

Numbers with a leading zero (``020111``), plus signs or spaces are text: they
are phone numbers and codes.  A column without values is text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed patterns of the types' texts
WHOLE = r"^-?(0|[1-9][0-9]*)$"
FIXED = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
REAL = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]{1,3})?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"
FACTS = ("present", "booleans", "wholes", "fixed", "reals", "dates", "times")


def column_facts(df: DataFrame, columns: Sequence[str] | None = None, delivery: Column | str | None = None) -> DataFrame:
    """One row per (delivery and) column: the number of values, and of those
    that each type takes, and the most digits before and after the point.  An
    empty text is a missing value, as in CSV."""
    columns = list(columns or df.columns)
    d = F.lit("") if delivery is None else F.col(delivery) if isinstance(delivery, str) else delivery
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])
    long = df.select(d.cast("string").alias("_delivery"), F.inline(cells)).withColumn("v", F.when(F.col("v") != "", F.col("v")))
    v = F.col("v")
    date, time = v.rlike(DATE) & F.try_to_date(v).isNotNull(), v.rlike(TIME) & v.try_cast("timestamp").isNotNull()
    fixed = v.rlike(FIXED)
    parts = F.split(F.ltrim(v, F.lit("-")), r"\.")
    each = dict(zip(FACTS, (v.isNotNull(), F.lower(v).isin("true", "false"), v.rlike(WHOLE), fixed, v.rlike(REAL), date,
                            date | time)))
    return long.groupBy("_delivery", "column_name").agg(
        *[F.count(F.when(c, F.lit(1))).alias(n) for n, c in each.items()],
        F.coalesce(F.max(F.when(fixed, F.length(parts[0]))), F.lit(0)).alias("before_point"),
        F.coalesce(F.max(F.when(fixed, F.length(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))))), F.lit(0)).alias("after_point"))


def fold(facts: DataFrame, path: str) -> None:
    """Write, or replace, the facts of the deliveries present."""
    (facts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_delivery").parquet(path))


def column_types(facts: DataFrame) -> dict[str, str]:
    """The type of every column over all deliveries: a row per column reaches
    the driver."""
    rows = facts.groupBy("column_name").agg(
        *[F.sum(n).alias(n) for n in FACTS], F.max("before_point").alias("before_point"),
        F.max("after_point").alias("after_point")).collect()
    return {r.column_name: _least(r.asDict()) for r in rows}


def _least(f: Mapping[str, int]) -> str:
    n = f["present"]
    if not n:
        return "string"
    if f["booleans"] == n:
        return "boolean"
    if f["wholes"] == n and f["before_point"] <= 18:
        return "bigint"
    if f["fixed"] == n and f["before_point"] + f["after_point"] <= 38:
        return f"decimal({max(1, f['before_point'] + f['after_point'])},{f['after_point']})"
    if f["reals"] == n:
        return "double"
    if f["dates"] == n:
        return "date"
    return "timestamp" if f["times"] == n else "string"


def typed_frame(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns as their types; others stay.  Every value that the facts
    have seen parses."""
    out = {}
    for c, kind in types.items():
        if c in df.columns and kind != "string":
            v = F.col(f"`{c}`").cast("string")
            out[c] = F.when(v != "", v).cast(kind)
    return df.withColumns(out) if out else df


def scan_inferred(spark: SparkSession, deliveries: Mapping[str, DataFrame], path: str) -> DataFrame:
    """The deliveries (name -> text frame) as one typed frame.  Their facts
    come from one job; those at ``path`` of deliveries that came earlier count
    as well, so a column never narrows."""
    facts = None
    for name, df in deliveries.items():
        part = column_facts(df, delivery=F.lit(name))
        facts = part if facts is None else facts.unionByName(part)
    fold(facts, path)
    types = column_types(spark.read.parquet(path))
    out = None
    for df in deliveries.values():
        part = typed_frame(df, types)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
