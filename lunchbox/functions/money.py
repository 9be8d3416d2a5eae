"""Money arithmetic.

Money is DECIMAL throughout: ``round(x, 2)`` on decimals is exact, whereas on
doubles Spark and Python disagree on ties.  (Day proration, which rounds half
to even like Python's ``round``, is in ``operators.calc``.)
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(10,2)"


def money(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast(MONEY)


def total_value(days: Column, daily_value: Column) -> Column:
    """``round(days * daily_value, 2)`` in decimal."""
    return F.round(days.cast("decimal(10,0)") * daily_value.cast(MONEY), 2).cast("decimal(18,2)")


def share(total: Column, fraction) -> Column:
    """``round(total * fraction, 2)`` in decimal (fraction as text or Column)."""
    f = fraction if isinstance(fraction, Column) else F.lit(fraction).cast("decimal(6,4)")
    return F.round(total.cast("decimal(18,2)") * f.cast("decimal(6,4)"), 2).cast("decimal(18,2)")
