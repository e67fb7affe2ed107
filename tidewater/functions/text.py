"""Column builders for text standardisation and free-text PII masking.

All are built-in JVM expressions (codegen'd), no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns (Java regex; the same text is valid RE2 for the oracle)
NON_DIGIT = r"\D"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
# a phone: a country code with + or 00, or an area code in brackets, or three
# groups; never dates (2024-01-01), addresses (192.168.100.10) or bare numbers
PHONE_PATTERN = (r"(?:\+|\b00)[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)|[0-9]{1,5})(?:[ .-]?[0-9]{2,6}){1,4}\b"
                 r"|\([0-9]{2,5}\)[ .-]?[0-9]{2,6}(?:[ .-]?[0-9]{2,6}){0,3}\b"
                 r"|\b[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}\b")
EMAIL_MASK = "<EMAIL>"
PHONE_MASK = "<PHONE>"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_email(c: Column | str) -> Column:
    """E-mail in lower case."""
    return F.lower(_c(c))


def normalize_phone(c: Column | str) -> Column:
    """Phone reduced to its digits, every non-digit removed."""
    return F.regexp_replace(_c(c), NON_DIGIT, "")


# Declared spelling of countries that capitalising would get wrong
COUNTRY_NAMES = {
    "unitedkingdom": "UnitedKingdom",
    "uk": "UnitedKingdom",
    "unitedstates": "UnitedStates",
    "usa": "UnitedStates",
    "newzealand": "NewZealand",
    "southafrica": "SouthAfrica",
    "saudiarabia": "SaudiArabia",
    "hongkong": "HongKong",
    "uae": "UAE",
}


def country_name(c: Column | str) -> Column:
    """Country by lookup of its declared spelling (P22, D13), whatever the
    case, spaces or separators; a country without an entry is one word and
    is capitalised."""
    c = _c(c)
    table = F.create_map(*[F.lit(x) for kv in COUNTRY_NAMES.items() for x in kv])
    known = F.try_element_at(table, F.regexp_replace(F.lower(c), r"[^a-z]", ""))
    return F.coalesce(known, F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30))))


def file_name_of(path: Column | str) -> Column:
    """Last path segment of a file path."""
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)


def file_extension(path: Column | str) -> Column:
    """Lower-cased extension without the dot ('' when there is none)."""
    return F.lower(F.regexp_extract(_c(path), r"\.([A-Za-z0-9]+)$", 1))


# The same e-mails, found in one pass: a match can only begin where a run of
# local-part characters does, or where the match before ended, so a long word
# is not tried again from each of its characters.
_EMAIL_ONCE = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _without(c: Column, mark: str, pattern: str, mask: str) -> Column:
    """``pattern`` replaced, in texts that hold ``mark`` (each match does)."""
    return F.when(F.contains(c, F.lit(mark)), F.regexp_replace(c, pattern, mask)).otherwise(c)


def _added(masked: Column, before: Column, mask: str) -> Column:
    """How many masks were put in: no match holds a character of the masks'
    brackets, so the ones that stood there before are still there."""
    gone = lambda c: F.length(c) - F.length(F.replace(c, F.lit(mask), F.lit("")))
    return ((gone(masked) - gone(before)) / len(mask)).cast("int")


def mask_emails(c: Column | str) -> Column:
    return _without(_c(c), "@", _EMAIL_ONCE, EMAIL_MASK)


def mask_phones(c: Column | str) -> Column:
    """Phones, in a text without e-mail addresses."""
    return F.regexp_replace(_c(c), PHONE_PATTERN, PHONE_MASK)


def count_emails(c: Column | str) -> Column:
    return _added(mask_emails(c), _c(c), EMAIL_MASK)


def count_phones(c: Column | str) -> Column:
    """Phones outside e-mail addresses."""
    rest = mask_emails(c)
    return _added(mask_phones(rest), rest, PHONE_MASK)


def mask_pii(c: Column | str) -> Column:
    """Replace every e-mail, then every phone-like number (Q7)."""
    return mask_phones(mask_emails(c))


def with_masked(df: DataFrame, text: str, emails: str = "n_emails", phones: str = "n_phones",
                masked: str = "masked_text") -> DataFrame:
    """``df`` with both counts and the masked text, each pattern run once."""
    d = df.withColumn("_no_emails", mask_emails(text)).withColumn(masked, mask_phones("_no_emails"))
    return d.withColumns({emails: _added(F.col("_no_emails"), F.col(text), EMAIL_MASK),
                          phones: _added(F.col(masked), F.col("_no_emails"), PHONE_MASK)}).drop("_no_emails")
