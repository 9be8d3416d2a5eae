"""Reports: distributions, KPI counts, financial summaries and top-N lists.

All aggregations are hash aggregations with a map-side partial step; top-N
lists are ``orderBy(...).limit(n)`` (planned as one TakeOrderedAndProject:
a per-partition top-N, then a merge of at most n rows per partition).  Every
top-N carries a full tie-break so the result is deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lunchbox import constants as K
from lunchbox.operators import presence
from lunchbox.operators.eligibility import eligible_employees, status_ok
from lunchbox.operators.joins import (employee_jobs, employee_star, employee_unions,
                                      union_state_side, working_days_side)
from lunchbox.periods import Period
from lunchbox.sources.model import HRModel


def long_form(df: DataFrame, pairs: list[tuple[str, str]], value_type: str = "double") -> DataFrame:
    """One-row wide aggregate -> (metric, value) rows via ``stack``."""
    args = ", ".join(f"'{label}', CAST(`{col}` AS {value_type})" for label, col in pairs)
    return df.selectExpr(f"stack({len(pairs)}, {args}) AS (metric, value)")


def eligible_top(model: HRModel, n: int = 10) -> DataFrame:
    """First n report-eligible employees by registration."""
    return (eligible_employees(model)
            .select("registration", "status", "job_title", "job_category", "union_name",
                    "state_name", F.col("daily_value").cast("double").alias("daily_value"))
            .orderBy("registration").limit(n))


def excluded_employees(model: HRModel) -> DataFrame:
    """Employee x exclusion rows (one per exclusion row), ordered by type, registration."""
    star = employee_jobs(model)
    return (star.join(model.exclusions, "employee_id")
            .select("registration", "job_title", "job_category", "exclusion_type",
                    F.col("specific_value").cast("double").alias("specific_value"), "notes")
            .orderBy("exclusion_type", "registration"))


def vacation_top(model: HRModel, n: int = 10) -> DataFrame:
    """Top n vacation rows by days (ties: registration, row id)."""
    star = employee_unions(model)
    return (star.join(model.vacations, "employee_id")
            .orderBy(F.desc("vacation_days"), "registration", "vacation_id")
            .select("registration", "job_title", "union_name", F.col("vacation_days").cast("long"),
                    "period_start", "period_end")
            .limit(n))


def termination_rule_label(notice_ok) -> F.Column:
    """Report label: notice OK -> prorated, otherwise none (as the report has it)."""
    return (F.when(notice_ok == F.lit(True), F.lit(K.REPORT_TERMINATION_PRORATED))
            .otherwise(F.lit(K.REPORT_TERMINATION_NONE)))


def terminated_employees(model: HRModel, n: int = 10) -> DataFrame:
    """First n terminations by date, with the report's rule label."""
    star = employee_jobs(model).select("employee_id", "registration", "job_title")
    return (star.join(model.terminations, "employee_id")
            .orderBy("termination_date", "registration", "termination_id")
            .select("registration", "job_title", "termination_date", "notice_ok",
                    termination_rule_label(F.col("notice_ok")).alias("termination_rule"))
            .limit(n))


def hires_in_month(model: HRModel, start, end, n: int = 10) -> DataFrame:
    """Hires with ``start <= hire_date <= end``, first n by date."""
    star = employee_star(model).select("employee_id", "registration", "job_title", "union_name",
                                       "daily_value")
    return (star.join(model.hires, "employee_id")
            .where(F.col("hire_date").between(F.lit(start), F.lit(end)))
            .orderBy(F.col("hire_date"), "registration", F.col("hire_id"))
            .select("registration", "job_title", "hire_date", "union_name",
                    F.col("daily_value").cast("double").alias("daily_value"))
            .limit(n))


def _union_groups(model: HRModel, period: Period | None) -> DataFrame:
    """Employees x union x state x working days of the period (inner)."""
    wd = working_days_side(model, period)
    return (model.employees.join(union_state_side(model), "union_id")
            .join(wd, "union_id"))


def union_distribution(model: HRModel, period: Period | None = None,
                       with_leave: bool = False) -> DataFrame:
    """Head count per union with working / vacation (/ on-leave) status counts."""
    g = _union_groups(model, period)
    aggs = [F.count("employee_id").alias("total_employees"),
            F.count_if(F.col("status") == K.STATUS_WORKING).alias("working"),
            F.count_if(F.col("status") == K.STATUS_VACATION).alias("on_vacation")]
    if with_leave:
        aggs.append(F.count_if(F.col("status").isin(K.EXCLUDED_STATUSES)).alias("on_leave"))
    out = (g.groupBy("union_id", "union_name", "state_name", "daily_value", "working_days")
           .agg(*aggs))
    cols = ["union_name", "state_name", F.col("daily_value").cast("double").alias("daily_value"),
            F.col("working_days").cast("long").alias("working_days"),
            F.col("total_employees").cast("long").alias("total_employees"),
            F.col("working").cast("long").alias("working"),
            F.col("on_vacation").cast("long").alias("on_vacation")]
    if with_leave:
        cols.append(F.col("on_leave").cast("long").alias("on_leave"))
    return out.orderBy(F.desc("total_employees"), "union_id").select(*cols)


def union_headcount(model: HRModel, period: Period | None = None) -> DataFrame:
    g = _union_groups(model, period)
    return (g.groupBy("union_id", "union_name", "daily_value", "working_days")
            .agg(F.count("employee_id").alias("total_employees"))
            .orderBy(F.desc("total_employees"), "union_id")
            .select("union_name", F.col("total_employees").cast("long"),
                    F.col("daily_value").cast("double"), F.col("working_days").cast("long")))


FACTS = ["vacations", "leaves", "terminations", "hires", "exclusions"]
EXCLUSION_KINDS = {"interns": K.EXCLUSION_INTERN, "apprentices": K.EXCLUSION_APPRENTICE, "abroad": K.EXCLUSION_ABROAD}


def _fact_rows(model: HRModel) -> list[DataFrame]:
    return [presence.keyed(model.table(t), "employee_id", s) for s, t in enumerate(FACTS)]


def kpi_counts(model: HRModel) -> DataFrame:
    """Labelled counts in (metric, value) form.

    Employees, facts and exclusions of each kind are counted by one aggregation on the employee: facts count where the employee
    exists, and eligible are employees whose own status and category allow it and who are on no exclusion list.
    """
    can = F.coalesce(status_ok(F.col("status")) & (F.col("job_category") == K.CATEGORY_EMPLOYEE), F.lit(False))
    kinds = {name: F.col("exclusion_type") == kind for name, kind in EXCLUSION_KINDS.items()}
    rows = _fact_rows(model)
    exclusions = len(FACTS) - 1
    rows[exclusions] = presence.keyed(model.exclusions, "employee_id", exclusions, **kinds)
    rows.append(presence.keyed(employee_jobs(model, "left"), "employee_id", presence.OWNER, can=can))
    held = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).groupBy("key").agg(
        F.count_if(F.col("source") == presence.OWNER).alias("owners"), F.count_if("can").alias("can"),
        *[F.count_if(F.col("source") == s).alias(f"n{s}") for s in range(len(FACTS))], *[F.count_if(k).alias(k) for k in kinds])
    there = (F.col("owners") > 0) & F.col("key").isNotNull()
    totals = held.agg(
        F.sum("owners").alias("employees"), F.sum(F.when(F.col(f"n{exclusions}") == 0, F.col("can"))).alias("eligible"),
        *[F.sum(F.when(there, F.col(c))).alias(c) for c in [*(f"n{s}" for s in range(len(FACTS))), *kinds]])
    columns = {"total_employees": "employees", "eligible_employees": "eligible", "excluded": f"n{exclusions}",
               "interns": "interns", "apprentices": "apprentices", "abroad": "abroad",
               "on_vacation": "n0", "on_leave": "n1", "terminated": "n2", "hired": "n3"}
    return presence.stacked(totals, list(columns), list(columns.values()), "metric", "value")


def _simple_calc_decimal(model: HRModel, period: Period | None) -> DataFrame:
    wd = working_days_side(model, period)
    p = period or model.period
    away = model.vacations.where((F.col("period_start") == F.lit(p.start)) & (F.col("period_end") == F.lit(p.end)))
    base = eligible_employees(model).join(wd, "union_id").join(away.select("employee_id", "vacation_days"), "employee_id", "left")
    days = F.col("working_days") - F.coalesce(F.col("vacation_days"), F.lit(0))
    total = days.cast("decimal(10,0)") * F.col("daily_value")
    return base.select(
        "registration", "job_title", "union_name", "daily_value", "working_days",
        F.coalesce(F.col("vacation_days"), F.lit(0)).alias("vacation_days"),
        days.alias("calc_days"),
        total.alias("total_value"),
        (total * F.lit(0.8).cast("decimal(2,1)")).alias("company_cost"),
        (total * F.lit(0.2).cast("decimal(2,1)")).alias("employee_discount"))


def simple_calc(model: HRModel, period: Period | None = None, limit: int | None = None) -> DataFrame:
    """Report-style calculation: no clamp, proration or rounding.

    The period's vacation rows are left-joined as they are (an employee with two
    rows appears twice), exactly as the report does.  ``limit`` keeps the first rows by
    registration (the report's sample); the registered query keeps all.
    """
    c = _simple_calc_decimal(model, period)
    out = c.select(
        "registration", "job_title", "union_name",
        F.col("daily_value").cast("double").alias("daily_value"),
        F.col("working_days").cast("long").alias("union_working_days"),
        F.col("vacation_days").cast("long").alias("vacation_days"),
        F.col("calc_days").cast("long").alias("calc_days"),
        *[F.col(x).cast("double").alias(x) for x in ("total_value", "company_cost", "employee_discount")])
    if limit is not None:
        out = out.orderBy("registration").limit(limit)
    return out


def financial_summary(model: HRModel, period: Period | None = None) -> DataFrame:
    """Count and money sums over the report-style calculation (sums in decimal)."""
    c = _simple_calc_decimal(model, period)
    return c.agg(
        F.count(F.lit(1)).cast("long").alias("eligible_employees"),
        *[F.sum(x).cast("double").alias(x) for x in ("total_value", "company_cost", "employee_discount")])


def validation_totals(purchase: DataFrame) -> DataFrame:
    """Head count and money sums of a purchase frame, in (metric, value) form.

    Zeros (not NULLs) on an empty input.
    """
    agg = purchase.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("t"),
        F.coalesce(F.sum("company_cost"), F.lit(0)).alias("c"),
        F.coalesce(F.sum("employee_discount"), F.lit(0)).alias("e"))
    agg = agg.select(F.col("n").cast("double").alias("n"),
                     *[F.round(F.col(x).cast("decimal(38,2)"), 2).cast("double").alias(x) for x in "tce"])
    labels = K.VALIDATION_LABELS
    return long_form(agg, [(labels[0], "n"), (labels[1], "t"), (labels[2], "c"), (labels[3], "e")])


def period_summary(results: DataFrame) -> DataFrame:
    """Totals per (month, year) of stored results."""
    return (results.groupBy("period_month", "period_year")
            .agg(F.count(F.lit(1)).cast("long").alias("total_employees"),
                 F.sum("calc_days").cast("long").alias("total_days"),
                 F.sum("total_value").cast("double").alias("total_value"),
                 F.sum("company_cost").cast("double").alias("company_cost"),
                 F.sum("employee_discount").cast("double").alias("employee_discount")))


def table_counts(model: HRModel) -> DataFrame:
    """Row count of every model table (facts of existing employees) plus a grand total: one aggregation by employee for all.

    A row of a dimension has no employee and goes to the NULL key, which holds one row a task.
    """
    dims = {"unions": model.unions, "states": model.states, "jobs": model.jobs, "companies": model.companies, "working_days": model.working_days}
    first = len(FACTS)
    rows = [presence.keyed(model.employees, "employee_id", presence.OWNER), *_fact_rows(model)]
    rows += [presence.keyed(df, F.lit(None), first + s, 1) for s, df in enumerate(dims.values())]
    held = presence.presence(rows, first + len(dims))
    there = (F.col("owners") > 0) & F.col("key").isNotNull()
    totals = held.agg(F.sum("owners").alias("owners"), *[
        F.sum(F.when(there, F.col(f"n{s}")) if s < first else F.col(f"n{s}")).alias(f"n{s}") for s in range(first + len(dims))])
    labels = ["employees", *FACTS, *dims]
    columns = ["owners", *(f"n{s}" for s in range(first + len(dims)))]
    whole = " + ".join(f"COALESCE({c}, 0)" for c in columns)
    return presence.stacked(totals, [*labels, "TOTAL"], [*columns, f"({whole})"], "table_name", "row_count")
