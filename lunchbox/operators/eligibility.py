"""The three eligibility definitions, kept apart on purpose.

* pipeline (purchase calc): exclusion list, leave overlap, category OR status
* view: exclusion list and status only, with company and full union name
* report: exclusion list, status, and category = FUNCIONARIO (NULL dropped)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lunchbox import constants as K
from lunchbox.operators.joins import (bounded, employee_jobs, employee_star, employees_on_leave, not_excluded,
                                      union_state_side)
from lunchbox.periods import Period
from lunchbox.sources.model import HRModel


def status_ok(status: Column) -> Column:
    """``status NOT IN (...)`` with SQL semantics (NULL status is not kept)."""
    return ~status.isin(K.EXCLUDED_STATUSES)


def category_status_filter(df: DataFrame) -> DataFrame:
    """Rows whose category and status do not remove them (NULLs kept)."""
    cats = ", ".join(f"'{c}'" for c in K.EXCLUDED_CATEGORIES)
    stats = ", ".join(f"'{s}'" for s in K.EXCLUDED_STATUSES)
    return df.where(f"NOT (COALESCE(job_category IN ({cats}), FALSE) "
                    f"OR COALESCE(status IN ({stats}), FALSE))")


def eligible_base(model: HRModel, period: Period | None = None) -> DataFrame:
    """Pipeline eligibility for one period: star join minus excluded, on leave,
    and excluded category/status."""
    p = period or model.period
    star = category_status_filter(employee_star(model))
    star = not_excluded(star, model.exclusions)
    return star.join(employees_on_leave(model, p), "employee_id", "left_anti")


def eligible_view(model: HRModel) -> DataFrame:
    """View eligibility: no category filter; company and full union name."""
    star = (employee_jobs(model)
            .join(bounded(model, "companies"), "company_id")
            .join(union_state_side(model), "union_id"))
    return (not_excluded(star, model.exclusions)
            .where(status_ok(F.col("status"))))


def report_eligible(df: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Report eligibility on any employee frame carrying status and job_category."""
    return (not_excluded(df, exclusions)
            .where(status_ok(F.col("status")) & (F.col("job_category") == K.CATEGORY_EMPLOYEE)))


def eligible_employees(model: HRModel) -> DataFrame:
    """Report eligibility: category must be FUNCIONARIO (star-joined rows)."""
    return report_eligible(employee_star(model), model.exclusions)
