"""Requirements the documents declare but the original code lacks.

Off the default path; each is labelled "declared" in the registry.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from lunchbox import constants as K
from lunchbox.functions.keys import BROADCAST_BYTES, estimated_bytes, small
from lunchbox.functions.money import MONEY
from lunchbox.periods import Period, periods_column, span
from lunchbox.sources.model import HRModel


def working_day_calendar(states: DataFrame, holidays: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """(state_id, calendar): for each state the number of working days from ``first`` to each day up to ``last``.

    Days between two dates are the difference of two look-ups (:func:`days_between_sql`), whatever the number of holidays:
    these (holiday_date, holiday_state_id; NULL state = everywhere) meet the days by equality only.  A state's
    array has an entry for each day; it is broadcast where states and days are few enough.
    """
    days = states.select("state_id", F.explode(F.expr(f"sequence(DATE'{first}', DATE'{last}')")).alias("day"))
    national = holidays.where("holiday_state_id IS NULL").select(F.col("holiday_date").alias("day")).distinct()
    regional = holidays.select(F.col("holiday_state_id").alias("state_id"), F.col("holiday_date").alias("day")).distinct()
    if small(holidays):
        national, regional = F.broadcast(national), F.broadcast(regional)
    off = (days.join(national.withColumn("n", F.lit(True)), "day", "left").join(regional.withColumn("r", F.lit(True)), ["state_id", "day"], "left"))
    works = F.when(F.dayofweek("day").between(2, 6) & F.col("n").isNull() & F.col("r").isNull(), 1).otherwise(0)
    so_far = F.sum(works).over(Window.partitionBy("state_id").orderBy("day")).cast("int")
    table = off.select("state_id", "day", so_far.alias("so_far")).groupBy("state_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("day", "so_far"))), lambda x: x["so_far"]).alias("calendar"))
    size = estimated_bytes(states)
    bound = None if size is None else size // 8 * 4 * ((last - first).days + 1)  # a state takes eight bytes at least
    return F.broadcast(table) if bound is not None and bound <= BROADCAST_BYTES else table


def days_between_sql(first: dt.date, start: str, end: str, calendar: str = "calendar") -> str:
    """Working days (SQL) of the inclusive range, from a calendar that begins with ``first``; an empty range has none."""
    upto = lambda d, less: (f"CASE WHEN datediff({d}, DATE'{first}') >= {less} "  # noqa: E731
                            f"THEN element_at({calendar}, datediff({d}, DATE'{first}') + {1 - less}) ELSE 0 END")
    return f"CASE WHEN {end} < {start} THEN 0 ELSE {upto(end, 0)} - {upto(start, 1)} END"


def working_days_from_calendar(unions: DataFrame, periods: list[Period], holidays: DataFrame,
                               states: DataFrame | None = None) -> DataFrame:
    """Working days per union and period from the calendar of the union's state."""
    first, last = span(periods)
    own = working_day_calendar(unions.select("state_id").distinct() if states is None else states, holidays, first, last)
    each = (unions.select("union_id", "state_id").join(own, "state_id")
            .select("union_id", "calendar", F.explode(periods_column(periods)).alias("p"))
            .select("union_id", "calendar", "p.period_start", "p.period_end"))
    return each.select("union_id", "period_start", "period_end",
                       F.expr(days_between_sql(first, "period_start", "period_end")).cast("long").alias("working_days"))


def with_calendar(model: HRModel, periods: list[Period], holidays: DataFrame) -> HRModel:
    """The model with working days from the calendar; they count as small where unions times periods are."""
    days = working_days_from_calendar(model.unions, periods, holidays, model.states)
    out = model.with_tables(working_days=days)
    size = estimated_bytes(model.unions)
    out._verified["working_days"] = size is not None and size * len(periods) <= BROADCAST_BYTES
    return out


def consolidated_base(active: DataFrame, hires: DataFrame, order: str) -> DataFrame:
    """Active base plus hires whose registration is missing from it, one whole row a registration: its first by load ``order``."""
    columns = [c for c in hires.columns if c != order]
    once = hires.where("registration IS NOT NULL").groupBy("registration").agg(F.min_by(F.struct(*columns), order).alias("row")).select("row.*")
    missing = once.join(active.select("registration"), "registration", "left_anti")
    return active.unionByName(missing, allowMissingColumns=True)


def purchase_flag(df: DataFrame, flag_col: str = "purchase_flag") -> DataFrame:
    """Rows whose 'in the purchase?' flag says yes (S/SIM/Y/YES/TRUE, any case)."""
    v = F.upper(F.trim(F.col(flag_col)))
    return df.where(v.isin("S", "SIM", "Y", "YES", "TRUE"))


def abroad_value(exclusions: DataFrame, employees_with_value: DataFrame) -> DataFrame:
    """Employees abroad with their specific value, else their state's daily value."""
    x = exclusions.where(F.col("exclusion_type") == K.EXCLUSION_ABROAD)
    return (x.join(employees_with_value.select("employee_id", "registration", "daily_value"), "employee_id")
            .select("employee_id", "registration",
                    F.coalesce(F.col("specific_value"), F.col("daily_value")).cast(MONEY).alias("daily_value")))
