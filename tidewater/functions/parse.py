"""Safe parsing Column builders.

Spark 4 runs with ANSI on: ``to_date``/``cast`` raise on one bad row and
fail the whole job.  The ``try_`` forms return NULL instead, and
``rejected`` tells a parse failure apart from a value that was NULL to begin
with, which is what the quarantine needs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str | None = None) -> Column:
    """ISO text (``2020-1-5`` and timestamps too) or ``fmt`` -> date; NULL if bad."""
    return F.try_to_date(_c(c), fmt) if fmt else F.try_to_date(_c(c))


def parse_int(c: Column | str) -> Column:
    return _c(c).try_cast("int")


def parse_money(c: Column | str) -> Column:
    """Amount text -> decimal(18,2): exact sums in any order."""
    return _c(c).try_cast(MONEY)


EXCEL_EPOCH = "1899-12-30"     # fixed: day zero of workbook date serials


def typed(c: Column | str, kind: str) -> Column:
    """Landed text as type ``kind``; NULL if it is none.  Whole numbers may be
    written as decimals (``12345.0``), dates as workbook day serials."""
    c = _c(c)
    if kind in ("bigint", "int", "smallint", "tinyint"):
        exact = c.try_cast("decimal(38,9)")
        return F.when(exact == F.floor(exact), exact.try_cast(kind))
    if kind == "date":
        serial = F.date_add(F.lit(EXCEL_EPOCH).cast("date"), c.try_cast("double").cast("int"))
        return F.when(c.rlike(r"^[0-9]+(\.[0-9]+)?$"), serial).otherwise(F.try_to_date(c))
    return c if kind == "string" else c.try_cast(kind)


def rejected(raw: Column | str, parsed: Column) -> Column:
    """True when a present raw value failed to parse."""
    return _c(raw).isNotNull() & parsed.isNull()


def split_list(c: Column | str, sep: str = ",") -> Column:
    """``'A, B ,,'`` -> ``['A','B']``: split, trim, drop blanks (I4).

    NULL input gives an empty list, like the reference's "no columns".
    """
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), sep), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")
