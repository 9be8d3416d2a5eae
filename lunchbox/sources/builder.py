"""Build an :class:`HRModel` from in-memory rows (tests, examples)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from lunchbox.functions.text import job_category
from lunchbox.periods import Period
from lunchbox.sources.model import HRModel

SCHEMAS = {
    "states": "state_id long, state_name string, uf string, daily_value decimal(10,2)",
    "unions": "union_id long, union_full_name string, union_name string, state_id long",
    "jobs": "job_id long, title string, category string",
    "employees": ("employee_id long, registration long, company_id long, job_id long, "
                  "union_id long, status string, hire_date date, termination_date date"),
    "working_days": "union_id long, period_start date, period_end date, working_days int",
    "vacations": "vacation_id long, employee_id long, period_start date, period_end date, vacation_days int",
    "leaves": "leave_id long, employee_id long, leave_type string, start_date date, end_date date",
    "terminations": "termination_id long, employee_id long, termination_date date, notice_ok boolean",
    "hires": "hire_id long, employee_id long, hire_date date",
    "exclusions": ("exclusion_id long, employee_id long, exclusion_type string, "
                   "specific_value decimal(10,2), notes string"),
    "companies": "company_id long, company_name string, tax_id string",
}


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def build_model(spark: SparkSession, period: Period, **rows) -> HRModel:
    """Every table defaults to empty; ``states`` daily values may be given as str.

    Employees may name their job by title: without ``jobs``, those titles become the jobs, numbered in their order.
    """
    tables = {}
    if "jobs" not in rows:
        titles = sorted({r[3] for r in rows.get("employees", []) if isinstance(r[3], str)})
        number = {t: k + 1 for k, t in enumerate(titles)}
        rows = {**rows, "employees": [(*r[:3], number.get(r[3], r[3]), *r[4:]) for r in rows.get("employees", [])]}
        listed = spark.createDataFrame([(k, t) for t, k in number.items()], "job_id long, title string")
        tables["jobs"] = listed.withColumn("category", job_category("title"))
    for name, schema in SCHEMAS.items():
        if name in tables:
            continue
        data = rows.get(name, [])
        if name == "states":
            data = [(a, b, c, None if v is None else Decimal(str(v))) for a, b, c, v in data]
        if name == "exclusions":
            data = [(a, b, c, None if v is None else Decimal(str(v)), n) for a, b, c, v, n in data]
        tables[name] = spark.createDataFrame(data, schema)
    if "companies" not in rows:
        tables["companies"] = spark.createDataFrame([(1, "Empresa Principal", None)], SCHEMAS["companies"])
    return HRModel(spark=spark, period=period, bounds={"states": 100, "unions": 100, "working_days": 1000,
                                                        "companies": 10}, **tables)
