"""Cleaning of text columns that arrive from spreadsheets and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers and formats used by the incoming reports.
BLANK_MARK = "nan"
NO_PRICE_MARK = "N/A"
NO_CHANGE_MARK = "-"
EXCHANGE_PREFIX = r"^[A-Z]+:"
MONEY_SIGNS = r"[\$,]"
NOT_DIGITS = r"[^0-9]"
US_DATE = r"^\d{2}/\d{2}/\d{4}$"
ISO_FORMAT = "yyyy-MM-dd"
US_FORMAT = "MM/dd/yyyy"


def is_blank(c: Column) -> Column:
    """Null, empty, only spaces, or the blank marker."""
    return c.isNull() | F.trim(c).isin("", BLANK_MARK)


def bare_ticker(c: Column) -> Column:
    """``" NYSE:ABC  "`` becomes ``ABC``; spaces on either side of the prefix go too."""
    return F.trim(F.regexp_replace(F.trim(c), EXCHANGE_PREFIX, ""))


def money_text(c: Column, missing: str | None = None) -> Column:
    """``$1,234.50`` as a double; the ``missing`` marker and dirty text give null."""
    plain = F.trim(F.regexp_replace(c, MONEY_SIGNS, ""))
    if missing is not None:
        plain = F.nullif(plain, F.lit(missing))
    number = plain.try_cast("double")
    return F.when(~F.isnan(number), number)


def digits_only(c: Column) -> Column:
    """All non-digits are dropped before the cast, so a sign or a decimal point is lost.

    Text without digits and numbers beyond 64 bits give null; ``quality`` rules
    on the result count them.
    """
    return F.regexp_replace(c, NOT_DIGITS, "").try_cast("long")


def mixed_date(c: Column) -> Column:
    """A date in either known format; null if neither reads the text.

    The shape picks the format. Trying one after the other would raise and
    swallow an error inside the parser for every row of the second format.
    """
    return F.when(c.rlike(US_DATE), F.try_to_date(c, US_FORMAT)).otherwise(F.try_to_date(c, ISO_FORMAT))


def iso_from_us_date(c: Column) -> Column:
    """Rewrite ``MM/dd/yyyy`` text as ``yyyy-MM-dd``; other text is kept."""
    swapped = F.regexp_replace(c, r"(\d{2})/(\d{2})/(\d{4})", "$3-$1-$2")
    return F.when(c.rlike(US_DATE), swapped).otherwise(c)


def safe_name(name: str) -> str:
    """A column name without spaces."""
    return name.replace(" ", "_")
