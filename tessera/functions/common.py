"""Column expressions shared by the operators (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """A currency value as an exact decimal, so sums do not depend on row order."""
    return col_(c).cast(MONEY)


def cents(c) -> Column:
    """A currency value as whole cents in a LONG (half-up), for exact integer sums.

    Long sums are exact and independent of row order like DECIMAL sums, but stay in
    primitive arithmetic (a DECIMAL sum buffer wider than 18 digits is a BigDecimal).
    """
    return F.floor(col_(c) * F.lit(100.0) + F.lit(0.5)).cast("long")


def from_cents(c) -> Column:
    """Cents back to currency units as double (the exact total, correctly rounded)."""
    return col_(c) / F.lit(100.0)


def money_sum(c) -> Column:
    """Exact sum of a currency column, returned as double."""
    return from_cents(F.sum(cents(c)))


def exact_avg(c) -> Column:
    """Mean of a currency column: exact sum divided by the non-null count."""
    return from_cents(F.sum(cents(c))) / F.count(col_(c))


def round_half_up(c, places: int = 2) -> Column:
    """``floor(x * 10^p + 0.5) / 10^p``.

    Used instead of ``round``: Spark rounds the decimal rendering of a double (1.005 -> 1.01)
    while most engines round its binary value (1.005 -> 1.0); this form gives the same
    answer everywhere.  From 2^53 / 10^p up a double has no digit at that place and is returned
    as it is (``floor`` gives a LONG, which would saturate).
    """
    scale = float(10 ** places)
    x = col_(c)
    return F.when(F.abs(x) * F.lit(scale) < F.lit(float(1 << 53)),
                  F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).otherwise(x.cast("double"))


def pct(num, den) -> Column:
    """100 * num / den as double; NULL (not an error) when den is 0 or NULL."""
    return F.try_divide(col_(num).cast("double") * F.lit(100.0), col_(den).cast("double"))


def null_strict_greatest(*cols) -> Column:
    """GREATEST that is NULL when any input is NULL (Spark's skips NULLs)."""
    cs = [col_(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def null_strict_least(*cols) -> Column:
    cs = [col_(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def full_name(first, last) -> Column:
    """CONCAT(first, ' ', last): NULL when either part is NULL."""
    return F.concat(col_(first), F.lit(" "), col_(last))


def month_start(c) -> Column:
    return F.trunc(F.to_date(col_(c)), "MM")


def month_label(c) -> Column:
    """'YYYY-MM-01' text of the month a date falls in."""
    return F.date_format(month_start(c), "yyyy-MM-01")


def thousands(c, places: int = 2) -> Column:
    """Number text with thousands separators and ``places`` decimals ("1,234,567.50")."""
    return F.format_number(col_(c), places)
