"""Faults on purpose: a deterministic share of every kind of bad row over any model.

The quality checks and the loading steps only show what they do where something is wrong.  ``dirty`` breaks rows by a remainder of their
id (``FAULTS``), so the faults grow with the data, are the same on every run, and can be written as plain SQL too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lunchbox.sources.model import HRModel

# fixed values: every how many-th row (by its id) has the fault
FAULTS = {
    "registration": 97,     # takes the registration of the employee before it
    "no_union": 89,
    "unknown_union": 83,
    "no_job": 79,
    "unknown_job": 73,
    "no_status": 71,
    "no_category": 5,       # jobs
    "unknown_employee": 13,  # rows of the five feeds
    "bad_date": 11,          # cells of the termination sheet
    "bad_registration": 17,
}
UNKNOWN = 10_000_000


def _every(column: str, fault: str):
    return F.pmod(F.col(column), F.lit(FAULTS[fault])) == 0


def dirty(model: HRModel) -> HRModel:
    """The model with faults in every table."""
    nothing = F.lit(None)
    employees = model.employees.withColumns({
        "registration": F.when(_every("employee_id", "registration"), F.col("registration") - 1).otherwise(F.col("registration")),
        "union_id": F.when(_every("employee_id", "no_union"), nothing.cast("long")).when(_every("employee_id", "unknown_union"), F.col("union_id") + UNKNOWN)
                     .otherwise(F.col("union_id")),
        "job_id": F.when(_every("employee_id", "no_job"), nothing.cast("long")).when(_every("employee_id", "unknown_job"), F.col("job_id") + UNKNOWN)
                   .otherwise(F.col("job_id")),
        "status": F.when(_every("employee_id", "no_status"), nothing.cast("string")).otherwise(F.col("status"))})
    feeds = {}
    for name, key in (("vacations", "vacation_id"), ("leaves", "leave_id"), ("terminations", "termination_id"), ("hires", "hire_id"), ("exclusions", "exclusion_id")):
        feeds[name] = model.table(name).withColumn(
            "employee_id", F.when(_every(key, "unknown_employee"), F.col("employee_id") + UNKNOWN).otherwise(F.col("employee_id")))
    states = model.states.withColumns({
        "daily_value": F.when(F.col("state_id") == 2, nothing.cast("decimal(10,2)")).otherwise(F.col("daily_value")),
        "uf": F.when(F.col("state_id") == 3, F.lit("AF")).otherwise(F.col("uf"))})
    unions = model.unions.withColumns({
        "state_id": F.when(F.col("union_id") == 7, F.lit(UNKNOWN).cast("long")).otherwise(F.col("state_id")),
        "union_full_name": F.when(F.col("union_id") == 9, F.lit("CANADA - SINDICATO")).otherwise(F.col("union_full_name"))})
    days = model.working_days.withColumn("working_days", F.when(F.col("union_id") == 3, F.lit(0)).when(F.col("union_id") == 4, nothing.cast("int"))
                                         .when(F.col("union_id") == 5, F.lit(40)).otherwise(F.col("working_days")))
    days = days.unionByName(days.where("union_id = 6"))
    jobs = model.jobs.withColumn("category", F.when(_every("job_id", "no_category"), nothing.cast("string")).otherwise(F.col("category")))
    return model.with_tables(employees=employees, states=states, unions=unions, working_days=days, jobs=jobs, **feeds)


def dirty_cells(text: DataFrame, order: str) -> DataFrame:
    """A termination sheet as text with cells that aren't of their type; ``order`` numbers its rows."""
    return text.withColumns({
        "DATA_DEMISSAO": F.when(_every(order, "bad_date"), F.lit("n/d")).otherwise(F.col("DATA_DEMISSAO")),
        "MATRICULA": F.when(_every(order, "bad_registration"), F.concat(F.lit("x"), F.col("MATRICULA"))).otherwise(F.col("MATRICULA"))})
