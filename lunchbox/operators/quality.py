"""Data-quality checks, each as a count of offenders (0 = ok).

Every check is an aggregate; the reports are in long form
(check, offenders) so any number of checks stack into one small frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lunchbox import constants as K
from lunchbox.operators import presence
from lunchbox.sources.model import HRModel


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _count(df: DataFrame, label: str, cond=None) -> DataFrame:
    agg = F.count_if(cond) if cond is not None else F.count(F.lit(1))
    return df.agg(agg.cast("long").alias("offenders")).select(F.lit(label).alias("check"), "offenders")


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once (aggregate + semi join)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).select(*keys)
    return df.join(dup, keys, "left_semi")


def _duplicates(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Number of rows whose key occurs more than once: one aggregation, no join."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("offenders")).select(
        F.lit(label).alias("check"), "offenders")


def dq_report(model: HRModel) -> DataFrame:
    """Duplicate registrations, missing union / job, bad daily value, bad working days."""
    emp = model.employees
    return _stack([
        _duplicates(emp, ["registration"], "duplicate_registration"),
        _checks_in_one_pass(emp, [("employee_without_union", F.col("union_id").isNull()),
                                  ("employee_without_job", F.col("job_id").isNull())]),
        _count(model.states, "invalid_daily_value",
               F.coalesce(F.col("daily_value") <= 0, F.lit(True))),
        _count(model.working_days, "invalid_working_days",
               ~F.coalesce(F.col("working_days").between(1, 31), F.lit(False))),
    ])


FACTS = ["vacations", "leaves", "terminations", "hires", "exclusions"]


#: foreign key of each check: table, column, and the table and column that hold its keys
FOREIGN_KEYS = [
    ("employees", "union_id", "unions", "union_id"),
    ("employees", "company_id", "companies", "company_id"),
    ("employees", "job_id", "jobs", "job_id"),
    ("unions", "state_id", "states", "state_id"),
    ("working_days", "union_id", "unions", "union_id"),
    *((t, "employee_id", "employees", "employee_id") for t in FACTS),
]


def dq_foreign_keys(model: HRModel) -> DataFrame:
    """Orphans per foreign key (rows whose reference does not exist; a NULL refers to nothing): one aggregation for all of them."""
    owners = sorted({(t, c) for _, _, t, c in FOREIGN_KEYS})
    domain = {owner: k for k, owner in enumerate(owners)}
    roles: dict[str, list] = {}
    for s, (table, column, owner, key) in enumerate(FOREIGN_KEYS):
        roles.setdefault(table, []).append((column, s, domain[owner, key]))
    for (table, column), k in domain.items():
        roles.setdefault(table, []).append((column, presence.OWNER, k))
    rows = []
    for table, own in roles.items():  # one scan a table, whatever its roles
        each = ", ".join(f"struct(CAST({d} AS BYTE) AS domain, CAST({c} AS LONG) AS key, CAST({s} AS BYTE) AS source)" for c, s, d in own)
        rows.append(model.table(table).selectExpr(f"inline(array({each}))").where("key IS NOT NULL"))
    return presence.orphans(rows, [f"{t}.{c}" for t, c, _, _ in FOREIGN_KEYS], "foreign_key")


def dq_unique_keys(model: HRModel) -> DataFrame:
    """Natural keys that repeat (number of offending rows) and NOT NULL breaches."""
    def dup_rows(df, keys, label):
        return _duplicates(df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])), keys, label)
    return _stack([
        dup_rows(model.states, ["state_name"], "states.state_name"),
        dup_rows(model.states, ["uf"], "states.uf"),
        dup_rows(model.unions, ["union_full_name"], "unions.union_full_name"),
        dup_rows(model.employees, ["registration"], "employees.registration"),
        dup_rows(model.working_days, ["union_id", "period_start", "period_end"],
                 "working_days.union_period"),
        _count(model.employees, "employees.status_not_null", F.col("status").isNull()),
        _count(model.states, "states.daily_value_not_null", F.col("daily_value").isNull()),
    ])


def dq_unmatched(feeds: dict[str, tuple[DataFrame, str]], employees: DataFrame) -> DataFrame:
    """Rows per feed whose registration has no employee (dropped at load): one
    aggregation for all feeds; every feed is reported, with 0 when nothing is unmatched.
    """
    rows = [presence.keyed(employees, "registration", presence.OWNER)]
    rows += [presence.keyed(df, F.col(f"`{col}`"), s) for s, (df, col) in enumerate(feeds.values())]
    return presence.orphans(rows, list(feeds), "feed")


def _checks_in_one_pass(df: DataFrame, checks: list[tuple[str, object]]) -> DataFrame:
    """Several conditional counts over one frame in a single aggregation,
    returned in long form (check, offenders)."""
    agg = df.agg(*[F.count_if(cond).cast("long").alias(f"c{i}") for i, (_, cond) in enumerate(checks)])
    args = ", ".join(f"'{label}', c{i}" for i, (label, _) in enumerate(checks))
    return agg.selectExpr(f"stack({len(checks)}, {args}) AS (check, offenders)")


def dq_results(calc: DataFrame) -> DataFrame:
    """Checks over a purchase calculation (``operators.calc.purchase_calc``), one pass."""
    excluded = (F.coalesce(F.col("job_category").isin(K.EXCLUDED_CATEGORIES), F.lit(False))
                | F.coalesce(F.col("status").isin(K.EXCLUDED_STATUSES), F.lit(False))
                | F.coalesce(F.col("excluded"), F.lit(False))
                | F.coalesce(F.col("on_leave"), F.lit(False)))
    return _checks_in_one_pass(calc, [
        ("excluded_group_present", excluded),
        ("split_not_total", (F.col("company_cost") + F.col("employee_discount")) != F.col("total")),
        ("negative_value", (F.col("days") < 0) | (F.col("total") < 0)),
        ("days_above_working_days", F.col("days") > F.coalesce(F.col("working_days"), F.lit(0))),
        ("hire_after_termination", F.col("effective_hire_date") > F.col("effective_termination_date")),
        ("terminated_before_period", F.col("effective_termination_date") < F.col("period_start")),
        ("missing_working_days", F.col("working_days").isNull()),
    ])
