"""Joins of the model: star join, fact lookups, semi/anti joins, interval overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lunchbox.functions.keys import lookup_join
from lunchbox.periods import Period
from lunchbox.sources.model import HRModel


def bounded(model: HRModel, name: str) -> DataFrame:
    """A dimension, broadcast when its size is checked.

    Bounds are declared only for tables whose size does not grow with the
    data (seeded dimensions, fixed reference tables); their bytes are checked once per
    model, from the plan's statistics.  Anything else is left to the planner: static size estimates and
    AQE's runtime statistics pick a broadcast only below the configured
    threshold, a shuffle join beyond it.
    """
    df = model.table(name)
    return F.broadcast(df) if model.small(name) else df


def union_state(model: HRModel) -> DataFrame:
    """Unions with their state: at most one row per union."""
    return bounded(model, "unions").join(bounded(model, "states"), "state_id")


def union_state_side(model: HRModel) -> DataFrame:
    """Union x state as a join side: broadcast when unions are verified small."""
    us = union_state(model)
    return F.broadcast(us) if model.small("unions") else us


def employee_star(model: HRModel) -> DataFrame:
    """Employees joined to job, union and state (inner joins, three hops).

    Union and state are broadcast once their size is checked.  The job table is
    broadcast up to the same size, and beyond it joined by a salted look-up.
    """
    return employee_jobs(model).join(union_state_side(model), "union_id")


def employee_jobs(model: HRModel, how: str = "inner") -> DataFrame:
    """Employees with title and stored category of their job (no union / state join)."""
    jobs = model.jobs.select("job_id", F.col("title").alias("job_title"), F.col("category").alias("job_category"))
    return lookup_join(model.employees, jobs, "job_id", how, salt_by="employee_id")


def employee_unions(model: HRModel) -> DataFrame:
    """Employees with job category and union (no state join)."""
    return employee_jobs(model).join(bounded(model, "unions"), "union_id")


def vacation_days(model: HRModel, period: Period | None = None) -> DataFrame:
    """Vacation days per employee for one period (partial + final hash agg)."""
    p = period or model.period
    v = model.vacations
    return (v.where((F.col("period_start") == F.lit(p.start)) & (F.col("period_end") == F.lit(p.end)))
            .groupBy("employee_id")
            .agg(F.sum("vacation_days").cast("long").alias("vacation_days")))


def working_days_for_period(model: HRModel, period: Period | None = None) -> DataFrame:
    p = period or model.period
    return (model.working_days
            .where((F.col("period_start") == F.lit(p.start)) & (F.col("period_end") == F.lit(p.end)))
            .select("union_id", "working_days"))


def working_days_side(model: HRModel, period: Period | None = None) -> DataFrame:
    """Working days of one period as a join side (broadcast when verified small)."""
    wd = working_days_for_period(model, period)
    return F.broadcast(wd) if model.small("working_days") else wd


def leave_overlaps(leaves: DataFrame, start, end) -> DataFrame:
    """Leave rows overlapping the inclusive interval ``[start, end]``.

    A missing leave start counts as the interval start; a missing end is
    open.  ``start``/``end`` may be literals or columns (per-period rows).
    """
    s = F.coalesce(F.col("start_date"), start if isinstance(start, F.Column) else F.lit(start))
    e = F.col("end_date")
    lo = start if isinstance(start, F.Column) else F.lit(start)
    hi = end if isinstance(end, F.Column) else F.lit(end)
    return leaves.where((s <= hi) & (e.isNull() | (e >= lo)))


def employees_on_leave(model: HRModel, period: Period | None = None) -> DataFrame:
    """Distinct employees with a leave overlapping the period."""
    p = period or model.period
    return leave_overlaps(model.leaves, p.start, p.end).select("employee_id").distinct()


def latest_by_employee(facts: DataFrame, order_col: str, value_cols: list[str],
                       prefix: str = "latest_") -> DataFrame:
    """Per employee, the values of the row with the largest ``order_col``.

    "Last row wins": ``max_by`` with the load-order id, computed as a
    partial + final aggregate (a hot employee contributes one row per task
    to the shuffle).
    """
    aggs = [F.max_by(F.col(c), F.col(order_col)).alias(prefix + c) for c in value_cols]
    return facts.groupBy("employee_id").agg(*aggs)


def latest_hire(model: HRModel) -> DataFrame:
    return latest_by_employee(model.hires, "hire_id", ["hire_date"])


def latest_termination(model: HRModel) -> DataFrame:
    return latest_by_employee(model.terminations, "termination_id",
                              ["termination_date", "notice_ok"])


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct join keys: a map-side partial aggregate first, so a key holding
    a large share of the rows reaches the shuffle as one row per task."""
    return df.select(*keys).distinct()


def not_excluded(df: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Rows whose employee is not on the exclusion list (``NOT IN`` as anti join).

    The exclusion keys are deduplicated first: an anti join cannot split a
    skewed right side, a distinct collapses it before the shuffle.
    """
    return df.join(distinct_keys(exclusions, "employee_id"), "employee_id", "left_anti")


def exclusion_flag(df: DataFrame, exclusions: DataFrame, name: str = "is_excluded") -> DataFrame:
    """Adds a boolean flag: employee appears on the exclusion list."""
    marks = distinct_keys(exclusions, "employee_id").withColumn(name, F.lit(True))
    return (df.join(marks, "employee_id", "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(False))))
