"""Rate helpers: ``CAST(100.0 * n / NULLIF(d, 0) AS DECIMAL(5,1))`` as Column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.functions.dates import col_


def raw_pct(num, den) -> Column:
    """Unrounded percentage as an exact decimal; NULL when the denominator is 0 or NULL."""
    return F.lit(Decimal("100.0")) * col_(num) / F.nullif(col_(den), F.lit(0))


def pct(num, den, precision: int = 5, scale: int = 1) -> Column:
    """Percentage rounded half away from zero to ``scale`` decimals."""
    return raw_pct(num, den).cast(f"decimal({precision},{scale})")


def dec(value: str, precision: int | None = None, scale: int | None = None) -> Column:
    """Decimal literal such as 40.0 (decimal(3,1)), typed like the SQL literal."""
    c = F.lit(Decimal(value))
    if precision is not None:
        c = c.cast(f"decimal({precision},{scale})")
    return c


def flag(cond) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL condition counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def count_if(cond) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint (0 on a group of NULL rows)."""
    return F.sum(flag(cond)).cast("bigint")


def count_when(cond) -> Column:
    """``COUNT(*)`` of the rows meeting ``cond`` (0, not NULL, on empty input)."""
    return F.count(F.when(cond, F.lit(1)))


def round_ratio(num, den, scale: int = 2, precision: int = 18) -> Column:
    """``num / den`` rounded half away from zero to ``scale`` decimals, exactly.

    ``num`` and ``den`` are integral; the quotient is formed with exact decimal remainder
    arithmetic, so no intermediate rounding can move a value across a tie.
    """
    n = col_(num).cast("decimal(38,0)")
    d = F.nullif(col_(den).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    unit = F.lit(10 ** scale).cast("decimal(38,0)")
    x = F.abs(n) * unit * 2 + d
    y = d * 2
    q = ((x - x % y) / y).cast("decimal(38,0)")
    signed = F.when(n < 0, -q).otherwise(q)
    return (signed / F.lit(10 ** scale)).cast(f"decimal({precision},{scale})")
