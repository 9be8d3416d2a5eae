"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query projects the driver's tables onto the HR model
(:func:`lunchbox.sources.testdata.load_model`) or onto sheet-shaped feeds
(:mod:`lunchbox.sources.sheets`) and runs one operator over the whole tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lunchbox.functions.text import job_category
from lunchbox import constants as K
from lunchbox.operators import (agreement, calc, declared, eligibility, ingest, joins,
                                maintenance, quality, reports)
from lunchbox.periods import Period
from lunchbox.session import ensure_checkpoint_dir
from lunchbox.sources import history, sheets, sinks
from lunchbox.sources.dirty import dirty, dirty_cells
from lunchbox.sources.rules import load_rules
from lunchbox.sources.testdata import catalog as load_model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# --- fixed parameters of the registered queries -----------------------------
HIRE_MONTH = (dt.date(1998, 4, 1), dt.date(1998, 4, 30))
LEAVE_SHEET_START = dt.date(1998, 4, 1)
RETENTION_FIRST_MONTH = (1998, 4)                # results of earlier months are deleted
VACATION_RETENTION_BEFORE = dt.date(1996, 6, 10)  # vacations ended before are deleted
UPSERT_AS_OF, UPSERT_BEFORE = "1998-05-16 00:00:00", "1998-04-16 00:00:00"
RULES = """{
  "valor_vr_diario_padrao": 37.5,
  "percentual_desconto_colaborador": 0.25,
  "percentual_custo_empresa": 0.75,
  "limites": {"max_desconto": 150.0},
  "excecoes": {
    "por_categoria": {"ESTAGIARIO": {"excluir": true}, "FUNCIONARIO": {"excluir": false}},
    "por_sindicato": {"BRAZIL": {"valor_vr_diario": 40.0}, "JAPAN": {"valor_vr_diario": 30.0}}
  }
}"""
# Consecutive periods of the multi-period run (the last one is the model's).
EARLIER_PERIODS = [("1998-02-15", "1998-03-15"), ("1998-03-15", "1998-04-15")]
# Holidays on weekdays in the period; NULL state = national.
HOLIDAYS = [("1998-04-21", None), ("1998-05-01", None), ("1998-04-23", 4)]
# ---------------------------------------------------------------------------


def query(name: str):
    """Register ``fn(model) -> DataFrame`` under ``name``."""
    def register(fn):
        def run(spark, sf_dir, _fn=fn):
            return _fn(load_model(spark, sf_dir))
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


def raw_query(name: str):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def _money(*cols):
    return [F.col(c).cast("double").alias(c) for c in cols]


# ----------------------------------------------------------------- sources --
def _sheet(df):
    return ingest.normalise_headers(df)


@raw_query("load_employees")
def _load_employees(spark, sf_dir):
    """SRC1: active employees sheet, typed."""
    s = _sheet(sheets.active_sheet(load_model(spark, sf_dir)))
    return s.select(F.col("MATRICULA").cast("long").alias("registration"),
                    F.col("EMPRESA").alias("company"), F.col("TITULO_DO_CARGO").alias("job_title"),
                    F.col("DESC_SITUACAO").alias("status"), F.col("SINDICATO").alias("union_full_name"))


@raw_query("load_vacations")
def _load_vacations(spark, sf_dir):
    """SRC2: vacation sheet, typed."""
    s = _sheet(sheets.vacation_sheet(load_model(spark, sf_dir)))
    return s.select(F.col("MATRICULA").cast("long").alias("registration"),
                    F.col("DESC_SITUACAO").alias("status"),
                    F.col("DIAS_DE_FERIAS").cast("long").alias("vacation_days"))


@raw_query("load_leaves")
def _load_leaves(spark, sf_dir):
    """SRC3: leave sheet, typed."""
    s = _sheet(sheets.leave_sheet(load_model(spark, sf_dir)))
    return s.select(F.col("MATRICULA").cast("long").alias("registration"),
                    F.col("DESC_SITUACAO").alias("leave_type"),
                    F.col("NA_COMPRA").alias("purchase_flag"))


@raw_query("purchase_flag")
def _purchase_flag(spark, sf_dir):
    """DEC4 (declared): leaves whose flag cell asks for the purchase."""
    return declared.purchase_flag(_load_leaves(spark, sf_dir)).select("registration", "leave_type")


@raw_query("load_terminations")
def _load_terminations(spark, sf_dir):
    """SRC4: termination sheet ('MATRICULA ' header), typed; notice = exactly 'OK'."""
    s = _sheet(sheets.termination_sheet(load_model(spark, sf_dir)))
    return s.select(F.col("MATRICULA").cast("long").alias("registration"),
                    F.col("DATA_DEMISSAO").cast("date").alias("termination_date"),
                    ingest.notice_flag(F.col("COMUNICADO_DE_DESLIGAMENTO")).alias("notice_ok"))


@raw_query("load_hires")
def _load_hires(spark, sf_dir):
    """SRC5: hires sheet, typed."""
    s = _sheet(sheets.hire_sheet(load_model(spark, sf_dir)))
    return s.select(F.col("MATRICULA").cast("long").alias("registration"),
                    F.col("ADMISSAO").cast("date").alias("hire_date"),
                    F.col("CARGO").alias("job_title"))


def _exclusion_sheets(spark, sf_dir):
    return {k: _sheet(v) for k, v in sheets.exclusion_sheets(load_model(spark, sf_dir)).items()}


@raw_query("load_exclusions")
def _load_exclusions(spark, sf_dir):
    """SRC6: intern, apprentice and abroad sheets as one tagged frame."""
    x = _exclusion_sheets(spark, sf_dir)
    u = ingest.exclusions_union(x["interns"], x["apprentices"], x["abroad"])
    return u.select("registration", "exclusion_type",
                    F.col("specific_value").cast("double").alias("specific_value"), "notes")


@query("dim_states")
def _dim_states(m):
    """SRC7: state dimension."""
    return m.states.select("state_id", "state_name", "uf", *_money("daily_value"))


@query("dim_unions")
def _dim_unions(m):
    """SRC7: union dimension."""
    return m.unions


@query("dim_working_days")
def _dim_working_days(m):
    """SRC7: working days per union and period."""
    return m.working_days.select("union_id", "period_start", "period_end",
                                 F.col("working_days").cast("long"))


@query("load_bases")
def _load_bases(m):
    """SRC8: the seven base frames of a calculation run, with their row counts."""
    bases = {
        "employees": joins.employee_star(m), "working_days": joins.working_days_for_period(m),
        "vacations": joins.vacation_days(m), "exclusions": m.exclusions, "leaves": m.leaves,
        "hires": m.hires, "terminations": m.terminations,
    }
    out = None
    for name, df in bases.items():
        one = df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
            F.lit(name).alias("base"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


@query("working_days_for_period")
def _wd_for_period(m):
    """SRC9: working days filtered on the period bounds."""
    return joins.working_days_for_period(m).select("union_id", F.col("working_days").cast("long"))


# ------------------------------------------------------------------ ingest --
@raw_query("cast_checked")
def _cast_checked(spark, sf_dir):
    """ING2: text termination sheet -> typed, with per-row cast errors."""
    s = _sheet(sheets.text_sheet(sheets.termination_sheet(load_model(spark, sf_dir))))
    c = ingest.cast_checked(s, {"MATRICULA": "bigint", "DATA_DEMISSAO": "date"})
    return c.select(F.col("MATRICULA").alias("registration"),
                    F.col("DATA_DEMISSAO").alias("termination_date"),
                    F.size("cast_errors").cast("long").alias("cast_errors"))


@raw_query("job_titles")
def _job_titles(spark, sf_dir):
    """ING3: distinct titles over the active, hires, intern and apprentice sheets."""
    x = _exclusion_sheets(spark, sf_dir)
    return ingest.job_titles((_sheet(sheets.active_sheet(load_model(spark, sf_dir))), "TITULO_DO_CARGO"),
                             (_sheet(sheets.hire_sheet(load_model(spark, sf_dir))), "CARGO"),
                             (x["interns"], "TITULO_DO_CARGO"),
                             (x["apprentices"], "TITULO_DO_CARGO"))


@query("job_category")
def _job_category(m):
    """ING4: title -> category (first matching keyword)."""
    return m.job_titles.select("title", job_category("title").alias("category"))


@query("job_dim")
def _job_dim(m):
    """ING5: jobs numbered 1..n in title order (distributed numbering)."""
    return ingest.job_dim(m.job_titles)


@raw_query("employee_dim")
def _employee_dim(spark, sf_dir):
    """ING6: active sheet -> employee rows with job / union ids (unknown -> 1)."""
    m = load_model(spark, sf_dir)
    s = _sheet(sheets.active_sheet(load_model(spark, sf_dir)))
    jobs = ingest.job_dim(m.job_titles)
    e = ingest.lookup_with_default(s, "TITULO_DO_CARGO", jobs, "title", "job_id", "job_id", salt_by="MATRICULA")
    e = ingest.lookup_with_default(e, "SINDICATO", joins.bounded(m, "unions"), "union_full_name",
                                   "union_id", "union_id", salt_by="MATRICULA")
    return e.select(F.col("MATRICULA").cast("long").alias("registration"), "job_id", "union_id",
                    F.col("DESC_SITUACAO").alias("status"), "job_id_matched", "union_id_matched")


def _resolve(spark, sf_dir, sheet_df):
    m = load_model(spark, sf_dir)
    s = _sheet(sheet_df).withColumn("registration", F.col("MATRICULA").cast("long"))
    return ingest.resolve_registrations(s, m.employees), m


@raw_query("resolve_vacations")
def _resolve_vacations(spark, sf_dir):
    """ING7/ING8: vacation sheet resolved by registration; each row keeps its own period, or gets the load's."""
    r, m = _resolve(spark, sf_dir, sheets.vacation_sheet(load_model(spark, sf_dir)))
    return ingest.with_dates(r, m.period.start, m.period.end).select(
        "employee_id", "period_start", "period_end", F.col("DIAS_DE_FERIAS").cast("long").alias("vacation_days"))


@raw_query("resolve_leaves")
def _resolve_leaves(spark, sf_dir):
    """ING7/ING8: leave sheet resolved; each row keeps its own dates, or gets the load's start and an open end."""
    r, _ = _resolve(spark, sf_dir, sheets.leave_sheet(load_model(spark, sf_dir)))
    return ingest.with_dates(r, LEAVE_SHEET_START, names=("start_date", "end_date")).select(
        "employee_id", F.col("DESC_SITUACAO").alias("leave_type"), "start_date", "end_date")


@raw_query("resolve_terminations")
def _resolve_terminations(spark, sf_dir):
    """ING7/ING8: termination sheet resolved; notice = exactly 'OK'."""
    s = _sheet(sheets.termination_sheet(load_model(spark, sf_dir))).withColumnRenamed("MATRICULA", "registration")
    r = ingest.resolve_registrations(s, load_model(spark, sf_dir).employees)
    return r.select("employee_id", F.col("DATA_DEMISSAO").cast("date").alias("termination_date"),
                    ingest.notice_flag(F.col("COMUNICADO_DE_DESLIGAMENTO")).alias("notice_ok"))


@raw_query("resolve_hires")
def _resolve_hires(spark, sf_dir):
    """ING7: hires sheet resolved by registration."""
    r, _ = _resolve(spark, sf_dir, sheets.hire_sheet(load_model(spark, sf_dir)))
    return r.select("employee_id", F.col("ADMISSAO").cast("date").alias("hire_date"))


@raw_query("exclusions_union")
def _exclusions_union(spark, sf_dir):
    """ING9: tagged union of the exclusion sheets, resolved to employees."""
    x = _exclusion_sheets(spark, sf_dir)
    u = ingest.exclusions_union(x["interns"], x["apprentices"], x["abroad"])
    r = ingest.resolve_registrations(u, load_model(spark, sf_dir).employees)
    return r.select("employee_id", "exclusion_type", *_money("specific_value"), "notes")


@query("backfill_hire_date")
def _backfill(m):
    """ING10: NULL employee hire dates filled from the first hire row."""
    return ingest.backfill_hire_date(m.employees, m.resolved("hires")).select("employee_id", "hire_date")


@query("upsert_changed")
def _upsert(m):
    """ING11: merge the back-filled snapshot into the loaded one; changed rows get the new stamp, the others keep theirs."""
    old = m.employees.withColumn("updated_at", F.lit(UPSERT_BEFORE).cast("timestamp_ntz"))
    out = ingest.upsert_changed(old, ingest.backfill_hire_date(m.employees, m.hires), "employee_id", ["status", "hire_date"],
                                as_of=F.lit(UPSERT_AS_OF).cast("timestamp_ntz"))
    return out.select("employee_id", "status", "hire_date", "changed", F.col("updated_at").cast("string").alias("updated_at"))


@query("merge_history")
def _merge_history(m):
    """ING11/SNK4: a stored snapshot merged with its back-filled version: only buckets with changed rows are rewritten, stamps last."""
    path = _stored(m, "snapshot")
    rows = m.employees.select("employee_id", "registration", "status", "hire_date")
    stamp = lambda t: F.lit(t).cast("timestamp_ntz")
    history.merge_snapshot(m.spark, path, rows, "employee_id", stamp(UPSERT_BEFORE))
    history.merge_snapshot(m.spark, path, ingest.backfill_hire_date(rows, m.hires), "employee_id", stamp(UPSERT_AS_OF))
    return history.read_snapshot(m.spark, path).select("employee_id", "registration", "status", "hire_date",
                                                       F.col("updated_at").cast("string").alias("updated_at"))


# ----------------------------------------------------------------- filters --
@query("employee_star")
def _employee_star(m):
    """JN1: employee -> job, union, state."""
    return joins.employee_star(m).select("employee_id", "registration", "status", "job_title",
                                         "job_category", "union_id", "union_name", "state_name",
                                         *_money("daily_value"))


@query("category_status_filter")
def _category_status_filter(m):
    """FLT1: category/status exclusion; NULL category kept."""
    return eligibility.category_status_filter(joins.employee_star(m)).select(
        "employee_id", "registration", "job_category", "status")


@query("eligible_base")
def _eligible_base(m):
    """FLT2: pipeline eligibility (exclusion list, leave overlap, category/status)."""
    return eligibility.eligible_base(m).select("employee_id", "registration", "job_category",
                                               "status", "union_name")


@query("eligible_view")
def _eligible_view(m):
    """FLT3: view eligibility (no category filter; company, full union name)."""
    m2 = m.with_tables(employees=ingest.backfill_hire_date(m.employees, m.resolved("hires")))
    return eligibility.eligible_view(m2).select(
        "employee_id", "registration", "status", "hire_date", "termination_date", "company_name",
        "job_title", "job_category", "union_full_name", "state_name", *_money("daily_value"))


@query("eligible_employees")
def _eligible_employees(m):
    """FLT4: report eligibility (category FUNCIONARIO)."""
    return eligibility.eligible_employees(m).select(
        "registration", "status", "job_title", "job_category", "union_name", "state_name",
        *_money("daily_value"))


# ------------------------------------------------------------------- joins --
@query("employee_working_days")
def _employee_working_days(m):
    """JN2: every employee with the working days of its union (NULL if missing)."""
    return (m.employees.join(joins.working_days_side(m), "union_id", "left")
            .select("employee_id", "union_id", F.col("working_days").cast("long")))


@query("employee_vacation")
def _employee_vacation(m):
    """JN3: every employee with summed vacation days (0 if none)."""
    return (m.employees.join(joins.vacation_days(m), "employee_id", "left")
            .select("employee_id", F.coalesce(F.col("vacation_days"), F.lit(0)).cast("long")
                    .alias("vacation_days")))


@query("exclusion_flag")
def _exclusion_flag(m):
    """JN4: employee flagged when on the exclusion list."""
    return joins.exclusion_flag(m.employees, m.exclusions).select("employee_id", "is_excluded")


@query("leave_overlap")
def _leave_overlap(m):
    """JN5: distinct employees with a leave overlapping the period."""
    return joins.employees_on_leave(m.with_tables(leaves=m.resolved("leaves")))


@query("not_excluded")
def _not_excluded(m):
    """JN6: employees not on the exclusion list (anti join)."""
    return joins.not_excluded(m.employees, m.exclusions).select("employee_id", "registration")


@query("latest_hire")
def _latest_hire(m):
    """JN9: last hire row per employee."""
    return joins.latest_by_employee(m.resolved("hires"), "hire_id", ["hire_date"])


@query("latest_termination")
def _latest_termination(m):
    """JN9: last termination row per employee."""
    return joins.latest_by_employee(m.resolved("terminations"), "termination_id",
                                    ["termination_date", "notice_ok"])


@query("employees_with_hire")
def _employees_with_hire(m):
    """JN10: employees with at least one hire row (semi join)."""
    return (m.employees.join(joins.distinct_keys(m.hires, "employee_id"), "employee_id", "left_semi")
            .select("employee_id", "registration"))


@query("duplicate_registrations")
def _duplicate_registrations(m):
    """JN11: employees whose registration occurs more than once."""
    return quality.duplicated_keys(m.employees, ["registration"]).select("employee_id", "registration")


@query("excluded_employees")
def _excluded_employees(m):
    """JN7/TOP5: employee x exclusion rows, by type and registration."""
    return reports.excluded_employees(m)


# ------------------------------------------------------------- calculation --
def _calc(m):
    return calc.purchase_calc(m)


@query("monthly_purchase")
def _monthly_purchase(m):
    """CAL8: eligible employees -> days, proration, money, notes, layout (flagship)."""
    return calc.monthly_purchase(m)


@query("periods")
def _periods(m):
    """CAL1: the periods present in the working-day and vacation tables, with
    label (MM/YYYY of the end) and inclusive length."""
    both = m.working_days.select("period_start", "period_end").unionByName(
        m.vacations.select("period_start", "period_end"))
    return calc.period_attributes(both)


@query("purchase_layout")
def _purchase_layout(m):
    """SNK1/PRJ1: the purchase sheet rows with their tab name."""
    return sinks.purchase_layout(calc.monthly_purchase(m))


@query("base_days")
def _base_days(m):
    """CAL2: max(working days - vacation days, 0)."""
    return _calc(m).select("employee_id", F.coalesce(F.col("working_days"), F.lit(0)).cast("long")
                           .alias("working_days"),
                           F.coalesce(F.col("vacation_days"), F.lit(0)).cast("long").alias("vacation_days"),
                           F.col("base_days").cast("long"))


@query("hire_proration")
def _hire_proration(m):
    """CAL3: hire inside the period prorates by remaining calendar days (half-even)."""
    return _calc(m).select("employee_id", F.col("effective_hire_date").alias("hire_date"),
                           "hired_in_period", F.col("base_days").cast("long"),
                           F.col("days_after_hire").cast("long"))


@query("termination_rule")
def _termination_rule(m):
    """CAL4: termination inside the period: zero with notice by day 15, else prorated."""
    return _calc(m).select("employee_id", F.col("effective_termination_date").alias("termination_date"),
                           F.col("notice").alias("notice_ok"), "terminated_in_period",
                           "terminated_to_zero", F.col("days_after_hire").cast("long"),
                           F.col("days").cast("long"))


@query("benefit_amounts")
def _benefit_amounts(m):
    """CAL5: total and the 80/20 split, rounded to cents."""
    return _calc(m).select("employee_id", F.col("days").cast("long"),
                           *_money("daily_value", "total", "company_cost", "employee_discount"))


@query("observations")
def _observations(m):
    """CAL6: observation text."""
    return _calc(m).select("employee_id", "notes")


@query("simple_calc")
def _simple_calc(m):
    """CAL7/JN8: report-style calculation over all report-eligible employees."""
    return reports.simple_calc(m)


@query("terminated_employees")
def _terminated(m):
    """CAL9/TOP3: first 10 terminations by date with the report's rule label."""
    return reports.terminated_employees(m)


def _results(m, periods=None):
    c = calc.purchase_calc(m, periods)
    return c.select("employee_id", F.col("period_month").cast("long"), F.col("period_year").cast("long"),
                    F.coalesce(F.col("working_days"), F.lit(0)).cast("long").alias("union_working_days"),
                    F.coalesce(F.col("vacation_days"), F.lit(0)).cast("long").alias("vacation_days"),
                    F.col("base_days").cast("long").alias("worked_days"),
                    F.col("days").cast("long").alias("calc_days"),
                    F.col("daily_value").cast("decimal(10,2)").alias("daily_value"),
                    F.col("total").alias("total_value"), "company_cost", "employee_discount", "notes")


@query("calc_results")
def _calc_results(m):
    """SNK4: result rows keyed by (employee, year, month)."""
    r = _results(m)
    return r.select(*[F.col(c).cast("double").alias(c) if c in
                      ("daily_value", "total_value", "company_cost", "employee_discount") else F.col(c)
                      for c in r.columns])


# --------------------------------------------------------------- agreement --
def _agreement_base(m):
    c = _calc(m)
    return c.select("registration", "union_name", "job_category", "days", "daily_value", "total",
                    "company_cost", "employee_discount")


def _rules(m):
    return load_rules(m.spark, RULES)


@query("agreement_default_value")
def _agr_default(m):
    """AGR1: non-positive daily value -> the document's default."""
    return agreement.default_value(_agreement_base(m), _rules(m)).select(
        "registration", *_money("daily_value"))


@query("agreement_total")
def _agr_total(m):
    """AGR1+AGR3: effective overlay (value default, TOTAL recomputed, shares kept;
    the category rule is inert)."""
    return agreement.apply_effective(_agreement_base(m), _rules(m)).select(
        "registration", F.col("days").cast("long"),
        *_money("daily_value", "total", "company_cost", "employee_discount"))


@query("agreement_exclude_category")
def _agr_exclude(m):
    """AGR2 (declared): rows of categories marked 'excluir' dropped."""
    return agreement.exclude_categories(_agreement_base(m), _rules(m)).select(
        "registration", "job_category")


@query("agreement_union_value")
def _agr_union(m):
    """AGR4 (declared): per-union daily value override."""
    return agreement.union_value(_agreement_base(m), _rules(m)).select(
        "registration", "union_name", *_money("daily_value"))


@query("agreement_split")
def _agr_split(m):
    """AGR5 (declared): shares from the document's percentages."""
    return agreement.split(_agreement_base(m), _rules(m)).select(
        "registration", *_money("total", "company_cost", "employee_discount"))


@query("agreement_cap")
def _agr_cap(m):
    """AGR6 (declared): employee share capped, excess to the company."""
    return agreement.cap(_agreement_base(m), _rules(m)).select(
        "registration", *_money("total", "company_cost", "employee_discount"))


@query("agreement_declared")
def _agr_declared(m):
    """AGR2-AGR6 (declared): every rule of the document, money recomputed."""
    return agreement.apply_declared(_agreement_base(m), _rules(m)).select(
        "registration", F.col("days").cast("long"),
        *_money("daily_value", "total", "company_cost", "employee_discount"))


# ------------------------------------------------------------ aggregations --
@query("vacation_days")
def _vacation_days(m):
    """AGG1: vacation days per employee for the period."""
    return joins.vacation_days(m.with_tables(vacations=m.resolved("vacations")))


@query("validation_totals")
def _validation_totals(m):
    """AGG2: head count and money totals of the purchase, long form."""
    return reports.validation_totals(_calc(m))


@query("union_distribution")
def _union_distribution(m):
    """AGG3/TOP6/FLT6: head count per union with status counts."""
    return reports.union_distribution(m)


@query("union_summary")
def _union_summary(m):
    """AGG4: as union_distribution plus the on-leave status count."""
    return reports.union_distribution(m, with_leave=True)


@query("union_headcount")
def _union_headcount(m):
    """AGG5: head count by union with value and working days."""
    return reports.union_headcount(m)


@query("kpi_counts")
def _kpi_counts(m):
    """AGG6: labelled counts."""
    return reports.kpi_counts(m)


@query("financial_summary")
def _financial_summary(m):
    """AGG7: count and money sums over the report-style calculation."""
    return reports.financial_summary(m)


@query("period_summary")
def _period_summary(m):
    """AGG8: results of three periods summed per month and year."""
    return reports.period_summary(_results(m, [Period.parse(a, b) for a, b in EARLIER_PERIODS] + [m.period]))


@query("table_counts")
def _table_counts(m):
    """AGG9: row counts of every table and the grand total."""
    return reports.table_counts(m)


# ----------------------------------------------------------------- top-N ---
@query("eligible_top")
def _eligible_top(m):
    """TOP1: first 10 report-eligible employees by registration."""
    return reports.eligible_top(m, 10)


@query("vacation_top")
def _vacation_top(m):
    """TOP2: top 10 vacation rows by days."""
    return reports.vacation_top(m, 10)


@query("hires_in_month")
def _hires_in_month(m):
    """TOP4/FLT5: first 10 hires of the month by date."""
    return reports.hires_in_month(m, *HIRE_MONTH, n=10)


# --------------------------------------------------------------- quality ---
@query("dq_report")
def _dq_report(m):
    """DQ1-DQ4: integrity counts."""
    return quality.dq_report(m)


@query("dq_foreign_keys")
def _dq_fk(m):
    """DQ5: orphans per foreign key."""
    return quality.dq_foreign_keys(m)


@query("dq_unique_keys")
def _dq_unique(m):
    """DQ6: repeated natural keys and NOT NULL breaches."""
    return quality.dq_unique_keys(m)


@raw_query("dq_unmatched")
def _dq_unmatched(spark, sf_dir):
    """DQ7: feed rows whose registration has no employee."""
    m = load_model(spark, sf_dir)
    feeds = sheets.registration_columns(m)
    return quality.dq_unmatched(feeds, m.employees)


@query("dq_results")
def _dq_results(m):
    """DQ8: checks over the purchase calculation."""
    return quality.dq_results(_calc(m))


# ------------------------------------------------------------ maintenance --
def _stored(m, name: str) -> str:
    """A new folder in the session's shared folder."""
    return f"{ensure_checkpoint_dir(m.spark)}/{name}-{uuid.uuid4().hex}"


@query("retain_results")
def _retain_results(m):
    """MNT1: stored results of three periods, after those before the cut-off month are deleted."""
    path = _stored(m, "results")
    sinks.write_results(_results(m, [Period.parse(a, b) for a, b in EARLIER_PERIODS] + [m.period]), path)
    maintenance.purge_results(m.spark, path, *RETENTION_FIRST_MONTH)
    kept = m.spark.read.parquet(path)
    return kept.select("employee_id", F.col("period_month").cast("long"), F.col("period_year").cast("long"), "calc_days")


@query("retain_vacations")
def _retain_vacations(m):
    """MNT1: stored vacations, after those whose period ended before the cut date are deleted (a date within a stored month)."""
    path = _stored(m, "vacations")
    maintenance.write_vacations(m.vacations, path)
    maintenance.purge_vacations(m.spark, path, VACATION_RETENTION_BEFORE)
    return m.spark.read.parquet(path).select("vacation_id", "employee_id", "period_end")


# ---------------------------------------------------------------- declared --
def _holidays(spark):
    rows = ", ".join(f"(DATE'{d}', CAST({s or 'NULL'} AS BIGINT))" for d, s in HOLIDAYS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(holiday_date, holiday_state_id)")


@query("working_days_from_calendar")
def _wd_calendar(m):
    """DEC1 (declared): working days from a weekday calendar minus holidays."""
    return declared.working_days_from_calendar(m.unions, [m.period], _holidays(m.spark), m.states)


@query("workday_proration")
def _workday_proration(m):
    """DEC2 (declared): hire / termination proration by working days, holidays left out."""
    return calc.purchase_calc(m, proration="workdays", holidays=_holidays(m.spark)).select(
        "employee_id", F.col("days_after_hire").cast("long"), F.col("days").cast("long"),
        *_money("total"))


@query("monthly_purchase_periods")
def _monthly_purchase_periods(m):
    """CAL8 over three consecutive periods in one plan (working days from the
    holiday calendar, DEC1): one row per eligible employee and period."""
    periods = [Period.parse(a, b) for a, b in EARLIER_PERIODS] + [m.period]
    return calc.monthly_purchase(declared.with_calendar(m, periods, _holidays(m.spark)), periods)


@query("consolidated_base")
def _consolidated_base(m):
    """DEC3 (declared): the active base (here: without those on vacation) plus hires missing from it, each by its first hire row."""
    known = joins.employee_jobs(m, "left").select("employee_id", "registration", "job_title", "status")
    active = known.where(~F.col("status").eqNullSafe(F.lit(K.STATUS_VACATION))).select("registration", "job_title")
    hires = m.hires.join(known, "employee_id").select("registration", "job_title", "hire_id")
    return declared.consolidated_base(active, hires, "hire_id")


@query("abroad_value")
def _abroad_value(m):
    """DEC5 (declared): employees abroad with their specific (or state) value."""
    return declared.abroad_value(m.resolved("exclusions"), joins.employee_star(m)).select(
        "employee_id", "registration", *_money("daily_value"))


# ----------------------------------------------- the same checks over faults --
def dirty_query(name: str):
    """Register ``fn(model with faults) -> DataFrame`` under ``name``."""
    def register(fn):
        def run(spark, sf_dir, _fn=fn):
            return _fn(dirty(load_model(spark, sf_dir)))
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


@dirty_query("dq_report_faults")
def _dq_report_faults(m):
    """DQ1-DQ4 over a model with faults of every kind."""
    return quality.dq_report(m)


@dirty_query("dq_foreign_keys_faults")
def _dq_fk_faults(m):
    """DQ5 over a model with faults."""
    return quality.dq_foreign_keys(m)


@dirty_query("dq_unique_keys_faults")
def _dq_unique_faults(m):
    """DQ6 over a model with faults."""
    return quality.dq_unique_keys(m)


@dirty_query("dq_unmatched_faults")
def _dq_unmatched_faults(m):
    """DQ7 over a model with faults."""
    return quality.dq_unmatched(sheets.registration_columns(m), m.employees)


@dirty_query("duplicate_registrations_faults")
def _duplicates_faults(m):
    """JN11: employees that share a registration."""
    return quality.duplicated_keys(m.employees, ["registration"]).select("employee_id", "registration")


@dirty_query("category_status_faults")
def _category_status_faults(m):
    """FLT1 where jobs have no category (kept) and employees no status (kept)."""
    return eligibility.category_status_filter(joins.employee_star(m)).select("employee_id", "job_category", "status")


@dirty_query("resolve_hires_faults")
def _resolve_hires_faults(m):
    """ING7: hires whose registration nobody has are dropped."""
    return ingest.resolve_registrations(sheets.registration_columns(m)["hires"][0].withColumnRenamed("MATRICULA", "registration"),
                                        m.employees).select("employee_id", "registration")


@dirty_query("employee_dim_faults")
def _employee_dim_faults(m):
    """ING6: a missing or unknown job or union becomes id 1."""
    s = ingest.normalise_headers(sheets.active_sheet(m))
    e = ingest.lookup_with_default(s, "TITULO_DO_CARGO", ingest.job_dim(m.job_titles), "title", "job_id", "job_id", salt_by="MATRICULA")
    unions = m.unions.groupBy("union_full_name").agg(F.min("union_id").alias("union_id"))
    e = ingest.lookup_with_default(e, "SINDICATO", unions, "union_full_name", "union_id", "union_id", salt_by="MATRICULA")
    return e.select(F.col("MATRICULA").cast("long").alias("registration"), "job_id", "union_id", "job_id_matched", "union_id_matched")


@dirty_query("kpi_counts_faults")
def _kpi_counts_faults(m):
    """AGG6 over a model with faults: facts of unknown employees don't count."""
    return reports.kpi_counts(m)


@raw_query("cast_checked_faults")
def _cast_checked_faults(spark, sf_dir):
    """ING2: a termination sheet with malformed cells; the bad ones are NULL and listed."""
    m = load_model(spark, sf_dir)
    s = _sheet(sheets.text_sheet(sheets.termination_sheet(m, with_id=True)))
    c = ingest.cast_checked(dirty_cells(s.withColumn("ID", F.col("ID").cast("long")), "ID"), {"MATRICULA": "bigint", "DATA_DEMISSAO": "date"})
    return c.select(F.col("ID").alias("termination_id"), F.col("MATRICULA").alias("registration"), F.col("DATA_DEMISSAO").alias("termination_date"),
                    F.concat_ws(",", "cast_errors").alias("cast_errors"))


@query("agreement_exclude_apprentices")
def _agr_exclude_apprentices(m):
    """AGR2 (declared) before the category filter: interns and apprentices marked 'excluir' are dropped from all employees."""
    rules = load_rules(m.spark, RULES.replace('"FUNCIONARIO": {"excluir": false}', '"APRENDIZ": {"excluir": true}'))
    return agreement.exclude_categories(joins.employee_jobs(m), rules).select("registration", "job_category")
