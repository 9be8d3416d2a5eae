"""The purchase calculation: days, proration, money split and notes.

Shape of the plan (``purchase_calc``):

1. employees with their job's category, category/status filter;
2. all per-employee inputs (vacation days, leave overlap, exclusion mark,
   first/latest hire, latest termination) are turned into typed rows of one
   union and aggregated **once** by employee, with a map-side partial aggregate before
   the shuffle.  Only vacations and leaves know periods: days go into a column for each
   period, leaves into bits.  When the model offers the
   feeds as one event view (``HRModel.events``) they are read in one pass;
   otherwise each feed table is read once;
3. one join of (1) and (2) on the employee.  Neither side grows with the number of
   periods; every employee gets its periods after the join, from a literal
   array, and then broadcast joins to
   union x state and to the working days (bounded: unions x periods).

So the whole calculation has two shuffles, whatever the number of feeds,
and a hot employee or feed collapses to one row per task before its shuffle.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lunchbox import constants as K
from lunchbox.functions.dates import inclusive_days
from lunchbox.operators.eligibility import category_status_filter
from lunchbox.operators.joins import bounded, employee_jobs, leave_overlaps, union_state_side
from lunchbox.periods import Period, period_indexes, span, with_period_fields
from lunchbox.sources.model import HRModel

#: periods of one aggregation: a column of days for each, and a bit of one long for leaves
MOST_PERIODS = 48

_FACT_SCHEMA = [
    ("period_index", "int"), ("vacation_days", "int"), ("leave_mask", "long"), ("excluded", "boolean"),
    ("hire_id", "long"), ("hire_date", "date"),
    ("termination_id", "long"), ("termination_date", "date"), ("notice_ok", "boolean"),
]


def _typed(df: DataFrame, **values: str) -> DataFrame:
    """Rows of the fact union: the given SQL expressions, NULL for the rest."""
    cols = ["employee_id"]
    for name, dtype in _FACT_SCHEMA:
        cols.append(f"CAST({values.get(name, 'NULL')} AS {dtype}) AS {name}")
    return df.selectExpr(*cols)


def _position_sql(periods: list[Period], start: str, end: str) -> str:
    """Index (SQL) of the period with these bounds, NULL if it isn't one of them; bounds are compared as one number."""
    days = lambda d: (d - dt.date(1970, 1, 1)).days
    bounds = ", ".join(f"{days(p.start) * 1_000_000 + days(p.end)}L" for p in periods)
    return f"nullif(array_position(array({bounds}), unix_date({start}) * 1000000L + unix_date({end})), 0) - 1"


def _overlap_mask_sql(periods: list[Period], start: str, end: str) -> str:
    """Bits (SQL) of the periods that a closed interval overlaps; a missing start is each period's own, a missing end is open."""
    bits = [f"CASE WHEN COALESCE({start}, DATE'{p.start}') <= DATE'{p.end}' AND ({end} IS NULL OR {end} >= DATE'{p.start}') "
            f"THEN {1 << k}L ELSE 0L END" for k, p in enumerate(periods)]
    return " + ".join(bits)


def _rows_from_events(events: DataFrame, periods: list[Period]) -> DataFrame:
    """Typed calc rows from the combined event view (one pass over it)."""
    lo, hi = span(periods)
    vac = f"kind = 'vacation' AND period_start >= DATE'{lo}' AND period_end <= DATE'{hi}'"
    leave = f"kind = 'leave' AND COALESCE(event_date, DATE'{lo}') <= DATE'{hi}' AND (end_date IS NULL OR end_date >= DATE'{lo}')"
    hire, term = "kind = 'hire'", "kind = 'termination'"
    return _typed(events.where(f"({vac}) OR ({leave}) OR {hire} OR {term}"),
                  period_index=f"CASE WHEN {vac} THEN {_position_sql(periods, 'period_start', 'period_end')} END",
                  vacation_days=f"CASE WHEN {vac} THEN vacation_days END",
                  leave_mask=f"CASE WHEN {leave} THEN {_overlap_mask_sql(periods, 'event_date', 'end_date')} END",
                  hire_id=f"CASE WHEN {hire} THEN event_id END",
                  hire_date=f"CASE WHEN {hire} THEN event_date END",
                  termination_id=f"CASE WHEN {term} THEN event_id END",
                  termination_date=f"CASE WHEN {term} THEN event_date END",
                  notice_ok=f"CASE WHEN {term} THEN notice_ok END")


def employee_facts(model: HRModel, periods: list[Period]) -> DataFrame:
    """One row per employee holding every calc input.

    Hires, terminations and exclusions don't depend on the period and are there once, however many periods
    there are.  A vacation is added to the column of its period (``days_<index>``), found by its place among the
    periods' bounds; a leave sets the bits of the periods it overlaps.
    """
    lo, hi = span(periods)
    if model.events is not None:
        facts = _rows_from_events(model.events, periods).unionByName(_typed(model.exclusions, excluded="TRUE"))
        return _aggregate_facts(facts, len(periods))
    vac = model.vacations.where((F.col("period_start") >= F.lit(lo)) & (F.col("period_end") <= F.lit(hi)))
    rows = [
        _typed(vac, vacation_days="vacation_days", period_index=_position_sql(periods, "period_start", "period_end")),
        _typed(leave_overlaps(model.leaves, lo, hi), leave_mask=_overlap_mask_sql(periods, "start_date", "end_date")),
        _typed(model.exclusions, excluded="TRUE"),
        _typed(model.hires, hire_id="hire_id", hire_date="hire_date"),
        _typed(model.terminations, termination_id="termination_id",
               termination_date="termination_date", notice_ok="notice_ok"),
    ]
    facts = rows[0]
    for r in rows[1:]:
        facts = facts.unionByName(r)
    return _aggregate_facts(facts, len(periods))


def _aggregate_facts(facts: DataFrame, periods: int) -> DataFrame:
    return facts.groupBy("employee_id").agg(
        *[F.sum(F.when(F.col("period_index") == k, F.col("vacation_days"))).alias(f"days_{k}") for k in range(periods)],
        F.bit_or("leave_mask").alias("leave_mask"),
        F.bool_or("excluded").alias("excluded"),
        # load order decides: the first hire row back-fills the employee's
        # own date, the last hire / termination row is the one used.
        F.min_by("hire_date", "hire_id").alias("first_hire_date"),
        F.max_by("hire_date", "hire_id").alias("latest_hire_date"),
        F.max_by("termination_date", "termination_id").alias("latest_termination_date"),
        F.max_by("notice_ok", "termination_id").alias("latest_notice_ok"),
    )


def purchase_calc(model: HRModel, periods: list[Period] | None = None,
                  proration: str = "calendar", strict: bool = False, holidays: DataFrame | None = None) -> DataFrame:
    """Eligible employees x periods with every intermediate of the calculation.

    ``proration="workdays"`` counts working days, without ``holidays`` where they are given.
    A union without working days for a period counts as 0 days (and shows in
    ``dq_results``); ``strict=True`` fails the job on such a row instead.
    """
    periods = periods or [model.period]
    if len(periods) > MOST_PERIODS:
        parts = [purchase_calc(model, periods[k:k + MOST_PERIODS], proration, strict, holidays) for k in range(0, len(periods), MOST_PERIODS)]
        return reduce(DataFrame.unionByName, parts)
    emp = category_status_filter(employee_jobs(model))
    # The union and state attributes are joined (broadcast) after the shuffle: the employee
    # side of the exchange carries keys, not repeated constants.
    facts = employee_facts(model, periods)
    wd = bounded(model, "working_days").select("union_id", "period_start", "period_end", "working_days")
    own = emp.join(facts, "employee_id", "left").where(~F.coalesce(F.col("excluded"), F.lit(False)))
    # each period once for every employee, after the shuffle; then its days and its leave bit
    each = with_period_fields(own.select("*", F.explode(period_indexes(periods)).alias("period_index")), periods)
    days = ", ".join(f"days_{k}" for k in range(len(periods)))
    each = each.withColumns({"vacation_days": F.expr(f"element_at(array({days}), period_index + 1)"),
                             "on_leave": F.expr("COALESCE(shiftright(leave_mask, period_index) & 1L, 0L) = 1L")})
    base = (each.where(~F.col("on_leave")).drop("leave_mask", *(f"days_{k}" for k in range(len(periods))))
            .join(union_state_side(model), "union_id").join(wd, ["union_id", "period_start", "period_end"], "left"))
    if strict:
        base = base.withColumn("working_days", F.when(
            F.col("working_days").isNull(),
            F.raise_error(F.concat(F.lit("no working days for union "), F.col("union_id").cast("string"),
                                   F.lit(" in period "), F.col("period_label"))))
            .otherwise(F.col("working_days")))
    if proration == "workdays":
        from lunchbox.operators.declared import working_day_calendar
        none = model.spark.sql("SELECT CAST(NULL AS DATE) AS holiday_date, CAST(NULL AS BIGINT) AS holiday_state_id WHERE FALSE")
        own = working_day_calendar(model.states, none if holidays is None else holidays, *span(periods))
        base = base.join(own, "state_id")
    return add_calculation(base, proration, span(periods)[0])


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _prorate_sql(days: str, part: str, whole: str) -> str:
    """round_half_even(days * clamp(part / whole, 0, 1)) as an int; an empty
    whole gives ratio 0.  The ratio is a double evaluated first, the same order
    of operations as the rule being reproduced, so ties round alike."""
    ratio = (f"LEAST(GREATEST(COALESCE(try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE)), "
             f"0D), 0D), 1D)")
    return f"CAST(bround(CAST({days} AS DOUBLE) * {ratio}, 0) AS INT)"


def _notes_sql() -> str:
    """Hire note, then termination note, joined by '; ' ('' if none)."""
    hired = K.NOTE_HIRED.split("{}")[0]
    before, after = K.NOTE_TERMINATED_PRORATED.split("{}")
    return (f"concat_ws({_sql_text(K.NOTE_SEPARATOR)}, "
            f"CASE WHEN hired_in_period THEN concat({_sql_text(hired)}, "
            f"date_format(effective_hire_date, 'dd/MM/yyyy')) END, "
            f"CASE WHEN terminated_to_zero THEN {_sql_text(K.NOTE_TERMINATED_WITH_NOTICE)} END, "
            f"CASE WHEN terminated_in_period AND NOT terminated_to_zero THEN concat({_sql_text(before)}, "
            f"date_format(effective_termination_date, 'dd/MM/yyyy'), {_sql_text(after)}) END)")


def add_calculation(base: DataFrame, proration: str = "calendar", calendar_from: dt.date | None = None) -> DataFrame:
    """Days, proration, money and notes on a frame holding the calc inputs.

    Required columns: period_start/end/days, working_days, vacation_days,
    hire_date (employee's own), first_hire_date, latest_hire_date,
    termination_date (employee's own), latest_termination_date,
    latest_notice_ok, daily_value.

    The rules are written as SQL expressions: the same expressions built
    call by call from Column objects cost about a thousand driver-JVM round
    trips per plan.  ``proration="workdays"`` (declared mode) prorates by
    working days of the employed part of the period instead of calendar days; the frame then has the ``calendar`` of each
    row's state, which begins with ``calendar_from``.
    """
    if proration == "workdays":
        from lunchbox.operators.declared import days_between_sql
        after_hire = days_between_sql(calendar_from, "effective_hire_date", "period_end")
        until_term = days_between_sql(calendar_from, "period_start", "effective_termination_date")
        whole = days_between_sql(calendar_from, "period_start", "period_end")
    elif proration == "calendar":
        after_hire = "datediff(period_end, effective_hire_date) + 1"
        until_term = "datediff(effective_termination_date, period_start) + 1"
        whole = "period_days"
    else:
        raise ValueError(f"unknown proration {proration!r}")
    hired = "COALESCE(effective_hire_date BETWEEN period_start AND period_end, FALSE)"
    terminated = "COALESCE(effective_termination_date BETWEEN period_start AND period_end, FALSE)"
    stages = [
        {"employee_hire_date": "COALESCE(hire_date, first_hire_date)",
         "effective_hire_date": "COALESCE(latest_hire_date, hire_date, first_hire_date)",
         "effective_termination_date": "COALESCE(latest_termination_date, termination_date)",
         "notice": "COALESCE(latest_notice_ok, FALSE)",
         "base_days": "CAST(GREATEST(COALESCE(working_days, 0) - COALESCE(vacation_days, 0), 0) AS INT)"},
        {"hired_in_period": hired,
         "days_after_hire": f"CASE WHEN {hired} THEN {_prorate_sql('base_days', after_hire, whole)} "
                            f"ELSE base_days END",
         "terminated_in_period": terminated,
         "terminated_to_zero": f"{terminated} AND notice "
                               f"AND dayofmonth(effective_termination_date) <= {K.NOTICE_DAY_LIMIT}"},
        {"days_after_termination": f"CASE WHEN terminated_to_zero THEN 0 "
                                   f"WHEN terminated_in_period THEN "
                                   f"{_prorate_sql('days_after_hire', until_term, whole)} "
                                   f"ELSE days_after_hire END"},
    ]
    out = base
    for stage in stages:
        out = out.withColumns({name: F.expr(sql) for name, sql in stage.items()})
    out = out.withColumn("days", F.expr("CAST(GREATEST(days_after_termination, 0) AS INT)"))
    return add_money(out).withColumn("notes", F.expr(_notes_sql()))


def add_money(df: DataFrame, company_share=K.COMPANY_SHARE, employee_share=K.EMPLOYEE_SHARE) -> DataFrame:
    """total = round(days x daily value, 2); shares = round(total x share, 2); all decimal."""
    total = ("CAST(round(CAST(days AS DECIMAL(10,0)) * CAST(COALESCE(daily_value, 0) AS DECIMAL(10,2)), 2) "
             "AS DECIMAL(18,2))")
    share_of = "CAST(round(total * CAST({} AS DECIMAL(6,4)), 2) AS DECIMAL(18,2))"
    return (df.withColumn("total", F.expr(total))
            .withColumns({"company_cost": F.expr(share_of.format(company_share)),
                          "employee_discount": F.expr(share_of.format(employee_share))}))


def period_attributes(df: DataFrame) -> DataFrame:
    """Distinct (period_start, period_end) of a frame with label and length."""
    return (df.select("period_start", "period_end").distinct()
            .select("period_start", "period_end",
                    F.date_format("period_end", "MM/yyyy").alias("period_label"),
                    inclusive_days(F.col("period_start"), F.col("period_end")).cast("long")
                    .alias("period_days")))


def layout(calc: DataFrame, with_period: bool = False) -> DataFrame:
    """Purchase-sheet projection (English names; display headers at write).

    ``with_period`` adds the period's dates, by which the writers partition.
    """
    return calc.selectExpr(
        *(["period_start", "period_end"] if with_period else []),
        "registration",
        "COALESCE(date_format(employee_hire_date, 'dd/MM/yyyy'), '') AS admission",
        "union_name",
        "period_label",
        "CAST(days AS BIGINT) AS days",
        "CAST(daily_value AS DOUBLE) AS daily_value",
        "CAST(total AS DOUBLE) AS total",
        "CAST(company_cost AS DOUBLE) AS company_cost",
        "CAST(employee_discount AS DOUBLE) AS employee_discount",
        "notes",
    )


def monthly_purchase(model: HRModel, periods: list[Period] | None = None, with_period: bool = False) -> DataFrame:
    """The whole purchase calculation, one row per eligible employee and period."""
    return layout(purchase_calc(model, periods), with_period)
