"""Accounting periods: inclusive ``[start, end]`` date ranges.

Periods are parameters of a run (a handful per job), so they live on the
driver as values and enter plans as literals or as a generator column; they
never need a join.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Period:
    start: dt.date
    end: dt.date

    def __post_init__(self):
        if self.end < self.start:
            raise ValueError(f"period end {self.end} before start {self.start}")

    @classmethod
    def parse(cls, start: str, end: str) -> "Period":
        return cls(dt.date.fromisoformat(start), dt.date.fromisoformat(end))

    @property
    def label(self) -> str:
        """``MM/YYYY`` of the end month."""
        return f"{self.end.month:02d}/{self.end.year}"

    @property
    def days(self) -> int:
        """Inclusive length in calendar days."""
        return (self.end - self.start).days + 1

    @property
    def slug(self) -> str:
        """Slash-free label, usable as a partition value or sheet tab."""
        return self.label.replace("/", ".")


def _period_sql(p: Period, index: int) -> str:
    return (f"named_struct('period_index', {index}, "
            f"'period_start', DATE'{p.start.isoformat()}', 'period_end', DATE'{p.end.isoformat()}', "
            f"'period_label', '{p.label}', 'period_days', {p.days}, "
            f"'period_month', {p.end.month}, 'period_year', {p.end.year})")


def periods_sql(periods: list[Period]) -> str:
    """The periods as a SQL array literal of structs (index, start, end, label,
    days, month, year).  Written as one SQL expression: a literal this size
    built call by call would cost a hundred driver-JVM round trips."""
    if not periods:
        raise ValueError("at least one period is required")
    return "array(" + ", ".join(_period_sql(p, i) for i, p in enumerate(periods)) + ")"


def periods_column(periods: list[Period]) -> Column:
    """Array of period structs; ``inline`` it to give each row every period."""
    return F.expr(periods_sql(periods))


PERIOD_FIELDS = ["period_start", "period_end", "period_label", "period_days", "period_month",
                 "period_year"]


def period_indexes(periods: list[Period]) -> Column:
    """The period indexes 0..n-1 (``explode`` it: one small int per row)."""
    return F.expr("array(" + ", ".join(str(i) for i in range(len(periods))) + ")")


def with_period_fields(df, periods: list[Period], index_col: str = "period_index"):
    """Attach the attributes of the period at ``index_col`` (array lookup)."""
    arr = periods_sql(periods)
    return df.selectExpr("*", *[f"element_at({arr}, {index_col} + 1).{name} AS {name}"
                                for name in PERIOD_FIELDS])


def span(periods: list[Period]) -> tuple[dt.date, dt.date]:
    """Smallest date range covering all periods (used for scan pushdown)."""
    return min(p.start for p in periods), max(p.end for p in periods)
