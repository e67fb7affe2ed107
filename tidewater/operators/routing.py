"""File -> table routing by the ingestion config.

The reference keeps a config row per file pattern and routes a file to the
first active row whose pattern is *contained* in the file name.  Here every
landed file is routed in one join:

* active rows only (``active_flag = 'Y'``);
* a file matches a row when its name contains the pattern (case-sensitive;
  a NULL pattern matches nothing, an empty one everything);
* among matches the longest pattern wins, ties by table name (D10);
* a file without a match keeps NULL routing columns (D11, never a crash).

The match is one equi-join whatever the size of the config: every substring
of a name whose length equals some pattern's length (bounded by the name, not
by the data) is joined with the patterns on equality.  Nothing is counted or
collected while the plan is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import split_list


def active_routes(config: DataFrame) -> DataFrame:
    """I1."""
    return config.where(F.col("active_flag") == "Y")


def _matches(files: DataFrame, routes: DataFrame, name_col: str) -> DataFrame:
    """Every (file, route) whose pattern the file's name contains."""
    lengths = routes.select(F.array_sort(F.collect_set(F.length("file_pattern")))).scalar()
    sized = files.select("*", F.explode(lengths).alias("_n"))
    places = F.sequence(F.lit(1), F.greatest(F.length(name_col) - F.col("_n") + 1, F.lit(0)))
    subs = F.transform(places, lambda i: F.substring(F.col(name_col), i, F.col("_n")))
    exploded = sized.select("*", F.explode(F.array_distinct(subs)).alias("_sub")).drop("_n")
    return exploded.join(routes, exploded["_sub"] == routes["file_pattern"]).drop("_sub")


def route_files(files: DataFrame, config: DataFrame, name_col: str = "file_name",
                id_col: str = "path") -> DataFrame:
    """I2 + I3: one output row per input file with ``table_name``,
    ``sensitive_cols`` and the parsed ``sensitive_list`` (NULL if unrouted)."""
    active = active_routes(config).select("file_pattern", "table_name", "sensitive_cols")
    # an empty pattern matches every name; it can only win for files no
    # other pattern matches, so it is applied as a fallback (scalar subquery)
    routes = active.where(F.length("file_pattern") > 0)
    fallback = (active.where(F.col("file_pattern") == "")
                .orderBy("table_name").limit(1))
    hits = _matches(files, routes, name_col)
    w = Window.partitionBy(id_col).orderBy(F.length("file_pattern").desc(),
                                           F.col("table_name").asc())
    best = (hits.withColumn("_rank", F.row_number().over(w)).where("_rank = 1")
                .select(id_col, "file_pattern", "table_name", "sensitive_cols"))
    routed = files.join(best, id_col, "left")
    unrouted = F.col("table_name").isNull()
    any_name = lambda c: fallback.select(c).scalar()  # noqa: E731  -- NULL without an empty pattern
    routed = routed.withColumns({
        "file_pattern": F.when(unrouted & any_name("table_name").isNotNull(), F.lit("")).otherwise(F.col("file_pattern")),
        "sensitive_cols": F.when(unrouted, any_name("sensitive_cols")).otherwise(F.col("sensitive_cols")),
        "table_name": F.coalesce("table_name", any_name("table_name")),
    })
    return routed.withColumn(
        "sensitive_list",
        F.when(F.col("table_name").isNotNull(), split_list("sensitive_cols")))
