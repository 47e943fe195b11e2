"""Money arithmetic that gives the same cents for every row order.

Double sums depend on the order rows arrive in, so two runs of one job can
differ in the last bits. Amounts are rounded to whole cents per row and added as
two 64-bit sums, of millions of cents and of the rest: exact, several times
faster than decimals, and no total of amounts comes near their limits. This does
not depend on ANSI mode. A single amount beyond 9.2e16 raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000


def cents(c: str | Column) -> Column:
    """An amount in whole cents."""
    value = F.rint((F.col(c) if isinstance(c, str) else c).cast("double") * 100)
    fits = value.isNull() | (F.abs(value) < 9.2e18)
    return F.when(fits, value.cast("long")).otherwise(F.raise_error(F.lit("amount beyond 9.2e16")).cast("long"))


def exact_sum(c: str | Column) -> Column:
    """Sum in cents as a decimal, which may be added up again later; null over no amounts."""
    whole = cents(c)
    high = F.sum(F.call_function("div", whole, F.lit(MILLION)))
    return high.cast("decimal(25,0)") * F.lit(MILLION).cast("decimal(7,0)") + F.sum(whole % MILLION).cast("decimal(25,0)")


def shown(in_cents: Column) -> Column:
    """Cents as an amount: the double nearest to the exact value."""
    return (in_cents.cast("decimal(38,0)") / F.lit(100).cast("decimal(3,0)")).cast("double")


def total(c: str | Column) -> Column:
    return shown(exact_sum(c))


def average(in_cents: Column, count: Column, digits: int = 2) -> Column:
    """A sum in cents over a count; divided and rounded as decimals, null over no rows.

    In doubles an average that ends in half a cent may fall to either side.
    """
    parts = F.nullif(count, F.lit(0)).cast("decimal(18,0)") * 100
    return F.round(in_cents.cast("decimal(38,0)") / parts, digits).cast("double")


def mean(c: str | Column, digits: int = 2) -> Column:
    return average(exact_sum(c), F.count(c), digits)


def ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` of doubles, rounded; null where ``den`` is 0 or null."""
    return F.round(num / F.nullif(den, F.lit(0.0)), digits)
