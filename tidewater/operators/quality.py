"""Data-quality and audit operators (Q1-Q6).

All are single aggregate / join plans: no collect, no per-row Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import rejected, typed


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q1: per column -- rows, NULLs, distinct non-NULL values.

    Rows and NULLs come from one aggregate without a shuffle of values.  For
    the distinct counts only non-NULL values are unpivoted, as 128-bit
    digests of their text (one width for all columns); a first aggregate on
    (column, digest) collapses repeats map-side, the second counts."""
    columns = list(columns or df.columns)
    plain = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}")
                                                      for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(columns))
    counts = plain.selectExpr("_rows", f"stack({len(columns)}, {pairs}) AS (column_name, _present)")
    values = ", ".join(f"'{c}', CASE WHEN `{c}` IS NOT NULL THEN unhex(md5(CAST(`{c}` AS STRING))) END" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {values}) AS (column_name, value)").where("value IS NOT NULL")
    distinct = (long.groupBy("column_name", "value").agg(F.lit(1).alias("_one"))
                .groupBy("column_name").agg(F.count(F.lit(1)).alias("_distinct")))
    return counts.join(distinct, "column_name", "left").select(
        "column_name", F.col("_rows").alias("row_count"), (F.col("_rows") - F.col("_present")).alias("null_count"),
        F.coalesce("_distinct", F.lit(0)).alias("distinct_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], *extra: Column) -> DataFrame:
    """Q2: keys that occur more than once, with their row count."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("row_count"), *extra)
              .where(F.col("row_count") > 1))


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Q3: child rows whose key has no parent row (left anti join)."""
    if isinstance(keys, Mapping):
        cond = [child[c] == parent[p] for c, p in keys.items()]
        return child.join(parent, cond, "left_anti")
    return child.join(parent.select(*keys), list(keys), "left_anti")


def quarantine(df: DataFrame, checks: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """Q4: one row per (rejected row, reason).

    ``checks`` maps a reason to a boolean Column that is true when the row
    fails it.  The reasons are stacked into an array and exploded, so a row
    failing two checks appears twice."""
    reasons = F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()])
    return (df.select(*keys_cols(keep), F.explode(F.array_compact(reasons)).alias("reason")))


def keys_cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def layer_totals(layer: str, df: DataFrame, amount: str | None) -> DataFrame:
    """Q5 building block: one row (layer, rows, exact amount total)."""
    total = F.sum(F.col(amount).cast("decimal(38,4)")) if amount else F.lit(None).cast("decimal(38,4)")
    return df.agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("row_count"),
                  total.alias("amount_total"))


def audit(layers: Sequence[tuple[str, DataFrame, str | None]]) -> DataFrame:
    """Q5: rows and amount in/out per layer, stacked (UNION ALL by name)."""
    out = None
    for name, df, amount in layers:
        t = layer_totals(name, df, amount)
        out = t if out is None else out.unionByName(t)
    return out.withColumn("amount_total", F.col("amount_total").cast("double"))


def harmonize(df: DataFrame, aliases: Mapping[str, str], target: Mapping[str, str] | Sequence[str],
              keep_unknown: bool = False) -> DataFrame:
    """Q6: a feed's columns, found by name (whatever the case, or through
    ``aliases``, source -> common), as the common schema.

    With ``target`` as name -> type, text is parsed to that type and missing
    columns are NULL of it, so a column's type doesn't depend on the feeds it
    meets; what fails to parse is NULL and listed in ``_rejected`` (column,
    value).  ``keep_unknown`` passes columns of no common name on."""
    kinds = dict(target) if isinstance(target, Mapping) else dict.fromkeys(target)
    lower = {k.lower(): v for k, v in aliases.items()} | {t.lower(): t for t in kinds}
    source: dict[str, str] = {}
    unknown = []
    for c in df.columns:
        name = lower.get(c.lower(), c)
        if name in kinds and name not in source:
            source[name] = c
        else:
            unknown.append(c)
    out, bad = [], []
    for name, kind in kinds.items():
        if name not in source:
            out.append(F.lit(None).cast(kind or "string").alias(name))
            continue
        raw = F.col(f"`{source[name]}`")
        value = raw if kind is None or df.schema[source[name]].dataType.simpleString() == kind \
            else typed(raw.cast("string"), kind)
        out.append(value.alias(name))
        if value is not raw:
            bad.append(F.when(rejected(raw, value), F.struct(F.lit(name).alias("column"),
                                                             raw.cast("string").alias("value"))))
    if isinstance(target, Mapping):
        empty = F.array().cast("array<struct<column:string,value:string>>")
        out.append((F.array_compact(F.array(*bad)) if bad else empty).alias("_rejected"))
    if keep_unknown:
        out += [F.col(f"`{c}`") for c in unknown]
    return df.select(*out)


def union_feeds(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; missing columns filled with NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
