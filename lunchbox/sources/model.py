"""The normalised HR model: a bundle of lazily-defined DataFrames.

Column names (all tables keyed by ``employee_id`` where relevant):

* ``states``        state_id, state_name, uf, daily_value decimal(10,2)
* ``unions``        union_id, union_full_name, union_name, state_id
* ``jobs``          job_id, title, category (as stored; NULL: none given)
* ``employees``     employee_id, registration, company_id, job_id, union_id,
                    status, hire_date, termination_date
* ``working_days``  union_id, period_start, period_end, working_days
* ``vacations``     vacation_id, employee_id, period_start, period_end, vacation_days
* ``leaves``        leave_id, employee_id, leave_type, start_date, end_date
* ``terminations``  termination_id, employee_id, termination_date, notice_ok
* ``hires``         hire_id, employee_id, hire_date
* ``exclusions``    exclusion_id, employee_id, exclusion_type, specific_value, notes
* ``companies``     company_id, company_name, tax_id
* ``events``        optional: vacations, hires, terminations and leaves as one
                    frame (employee_id, kind, event_id, event_date, end_date,
                    vacation_days, notice_ok, period_start, period_end), for a
                    source that holds all four feeds; the calculation then
                    reads them in one pass instead of four

The ``*_id`` of a fact row is its load order: "last row wins" lookups order
by it.  Fact tables may carry rows whose employee does not exist (an
unmatched registration); :meth:`HRModel.resolved` drops them, as loading
does.  ``employees.hire_date`` is as loaded (NULL until back-filled, see
``operators.ingest.backfill_hire_date``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from lunchbox.functions.keys import small
from lunchbox.periods import Period

FACT_TABLES = ("vacations", "leaves", "terminations", "hires", "exclusions")


@dataclass(frozen=True)
class HRModel:
    spark: SparkSession
    states: DataFrame
    unions: DataFrame
    jobs: DataFrame
    employees: DataFrame
    working_days: DataFrame
    vacations: DataFrame
    leaves: DataFrame
    terminations: DataFrame
    hires: DataFrame
    exclusions: DataFrame
    companies: DataFrame
    period: Period
    events: DataFrame | None = None
    # Dimensions that don't grow with the data, with their expected rows.  Their
    # size in bytes is checked (Catalyst's estimate, no job) before they are broadcast.
    bounds: dict = field(default_factory=dict)
    _verified: dict = field(default_factory=dict, compare=False, repr=False)

    def resolved(self, name: str) -> DataFrame:
        """Fact table restricted to existing employees (unmatched rows dropped)."""
        facts = getattr(self, name)
        # employee_id is the employee key (unique); a skewed fact side is split
        # by AQE's skew-join handling, which covers left semi joins.
        return facts.join(self.employees.select("employee_id"), "employee_id", "left_semi")

    @property
    def job_titles(self) -> DataFrame:
        """The distinct titles of the jobs."""
        return self.jobs.select("title").where(F.col("title").isNotNull()).distinct()

    def small(self, name: str) -> bool:
        """Is ``name`` declared small, and its size in bytes known to be?"""
        if name not in self.bounds:
            return False
        if name not in self._verified:
            self._verified[name] = small(self.table(name))
        return self._verified[name]

    def with_tables(self, **tables) -> "HRModel":
        """A copy with some tables replaced (the combined event view is dropped
        when any of the feeds it stands for is replaced)."""
        if set(tables) & {"vacations", "hires", "terminations", "leaves"}:
            tables.setdefault("events", None)
        return replace(self, _verified={}, **tables)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


