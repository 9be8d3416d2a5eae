"""Projection of the driver's TPC-H-like tables onto the HR model.

The mapping (FIXTURES.md section 4) turns regions into states, nations into
unions, parts into job titles, customers into employees and order events into
the vacation / hire / termination / leave feeds.  Everything here is a lazy
column expression over a Parquet scan; the feeds hold all dates.
"""

from __future__ import annotations

import datetime as dt
import weakref

from pyspark.sql import DataFrame, SparkSession, functions as F

from lunchbox import constants as K
from lunchbox.functions.dates import as_date
from lunchbox.functions.text import job_category
from lunchbox.periods import Period
from lunchbox.sources.model import HRModel

# --- fixed values of the projection (FIXTURES.md section 4) ----------------
PERIOD = Period(dt.date(1998, 4, 15), dt.date(1998, 5, 15))
PERIOD_DAY = 15               # accounting periods run from this day to the same day of the next month
REGISTRATION_BASE = 30000
EXCLUSION_BALANCE = 9700      # customers above this balance are excluded
NOTICE_PRIORITIES = ["1-URGENT", "2-HIGH"]
TITLE_PREFIX_BY_SIZE = {1: "ESTAGIARIO ", 2: "JOVEM APRENDIZ ", 3: "DIRETOR "}
TITLE_PREFIX_OTHER = "ANALISTA "
STATE_VALUE_BY_REGION = {"EUROPE": "37.50", "ASIA": "0"}
STATE_VALUE_OTHER = "35.00"
LEAVE_TYPE = "Afastamento"
# ---------------------------------------------------------------------------

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Session-level catalog: the lazy table definitions of a directory are built
# once per session (file listing and footer reads happen on the driver), then
# every query derives its own plan from them.  No data is cached.  Keyed by
# the session object itself: a cloned session (e.g. inside foreachBatch) has
# its own configuration and gets its own definitions.
_CATALOG: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def catalog(spark: SparkSession, sf_dir: str, period: Period = PERIOD) -> HRModel:
    models = _CATALOG.setdefault(spark, {})
    key = (sf_dir.rstrip("/"), period)
    if key not in models:
        models[key] = load_model(spark, sf_dir, period)
    return models[key]


def refresh_catalog() -> None:
    """Forget cached table definitions (after the files changed)."""
    _CATALOG.clear()


def _title_from_part(part: DataFrame) -> DataFrame:
    prefix = F.lit(TITLE_PREFIX_OTHER)
    for size in sorted(TITLE_PREFIX_BY_SIZE, reverse=True):
        prefix = F.when(F.col("p_size") == size, F.lit(TITLE_PREFIX_BY_SIZE[size])).otherwise(prefix)
    return part.select("p_partkey", F.concat(prefix, F.col("p_name")).alias("title"))


def _order_date() -> F.Column:
    return as_date(F.col("o_orderdate"))


def states(spark, sf_dir) -> DataFrame:
    value = F.lit(STATE_VALUE_OTHER)
    for region, v in STATE_VALUE_BY_REGION.items():
        value = F.when(F.col("r_name") == region, F.lit(v)).otherwise(value)
    return read_table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).cast("long").alias("state_id"),
        F.col("r_name").alias("state_name"),
        F.substring("r_name", 1, 2).alias("uf"),
        value.cast("decimal(10,2)").alias("daily_value"))


def unions(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).cast("long").alias("union_id"),
        F.concat(F.col("n_name"), F.lit(" - SINDICATO")).alias("union_full_name"),
        F.col("n_name").alias("union_name"),
        (F.col("n_regionkey") + 1).cast("long").alias("state_id"))


def jobs(spark, sf_dir) -> DataFrame:
    """The job table: a job for each part, with its stored category."""
    titles = _title_from_part(read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name"))
    return titles.select((F.col("p_partkey") + 1).cast("long").alias("job_id"), "title", job_category("title").alias("category"))


def employees(spark, sf_dir) -> DataFrame:
    """Employees with the id of their job: customer keys go round the whole key range of the part table."""
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    status = (F.when(F.col("c_acctbal") < -800, F.lit(K.STATUS_SICK_LEAVE))
              .when(F.col("c_acctbal") < -650, F.lit(K.STATUS_MATERNITY))
              .when(F.col("c_acctbal") < -500, F.lit(K.STATUS_MEDICAL_NOTE))
              .when(F.col("c_mktsegment") == "FURNITURE", F.lit(K.STATUS_VACATION))
              .otherwise(F.lit(K.STATUS_WORKING)))
    # a scalar subquery over a partial ``max`` (one row per task)
    keys = read_table(spark, sf_dir, "part").agg(F.max("p_partkey") + 1).scalar()
    return cust.select(
        (F.col("c_custkey") + 1).cast("long").alias("employee_id"),
        (F.col("c_custkey") + REGISTRATION_BASE).cast("long").alias("registration"),
        F.lit(1).cast("long").alias("company_id"),
        (F.pmod(F.col("c_custkey"), keys) + 1).cast("long").alias("job_id"),
        (F.col("c_nationkey") + 1).cast("long").alias("union_id"),
        status.alias("status"),
        F.lit(None).cast("date").alias("hire_date"),
        F.lit(None).cast("date").alias("termination_date"))


def working_days(spark, sf_dir, period: Period = PERIOD) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).cast("long").alias("union_id"),
        F.lit(period.start).alias("period_start"),
        F.lit(period.end).alias("period_end"),
        (F.lit(21) + F.col("n_nationkey") % 2).cast("int").alias("working_days"))


def _orders(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


# --- the four order-derived feeds: filters and values, defined once ---------
def _feed_filters() -> dict:
    """Which feed an order belongs to, whatever its date: the feeds hold every
    period, and an operator that asks for one filters it."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return {
        "vacation": status == "F",
        "hire": status == "O",
        "termination": status == "P",
        "leave": (status == "F") & (priority == "1-URGENT"),
    }


def _own_period() -> tuple[F.Column, F.Column]:
    """Start and end of the accounting period that an order's date begins or falls in."""
    d = _order_date()
    this_month = F.date_add(F.trunc(d, "MM"), PERIOD_DAY - 1)
    start = F.add_months(this_month, F.when(F.dayofmonth(d) >= PERIOD_DAY, F.lit(0)).otherwise(F.lit(-1)))
    return start, F.add_months(start, 1)


def _order_employee() -> F.Column:
    return (F.col("o_custkey") + 1).cast("long")


def _vacation_days() -> F.Column:
    return (F.lit(1) + F.col("o_orderkey") % 30).cast("int")


def _notice_ok() -> F.Column:
    return F.coalesce(F.col("o_orderpriority").isin(NOTICE_PRIORITIES), F.lit(False))


def _leave_end() -> F.Column:
    return F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(_order_date(), (F.col("o_orderkey") % 60).cast("int")))


def vacations(spark, sf_dir) -> DataFrame:
    o = _orders(spark, sf_dir)
    start, end = _own_period()
    return (o.where(_feed_filters()["vacation"])
            .select(F.col("o_orderkey").alias("vacation_id"),
                    _order_employee().alias("employee_id"),
                    start.alias("period_start"),
                    end.alias("period_end"),
                    _vacation_days().alias("vacation_days")))


def hires(spark, sf_dir) -> DataFrame:
    o = _orders(spark, sf_dir)
    return (o.where(_feed_filters()["hire"])
            .select(F.col("o_orderkey").alias("hire_id"),
                    _order_employee().alias("employee_id"),
                    _order_date().alias("hire_date")))


def terminations(spark, sf_dir) -> DataFrame:
    o = _orders(spark, sf_dir)
    return (o.where(_feed_filters()["termination"])
            .select(F.col("o_orderkey").alias("termination_id"),
                    _order_employee().alias("employee_id"),
                    _order_date().alias("termination_date"),
                    _notice_ok().alias("notice_ok")))


def leaves(spark, sf_dir) -> DataFrame:
    o = _orders(spark, sf_dir)
    return (o.where(_feed_filters()["leave"])
            .select(F.col("o_orderkey").alias("leave_id"),
                    _order_employee().alias("employee_id"),
                    F.lit(LEAVE_TYPE).alias("leave_type"),
                    _order_date().alias("start_date"),
                    _leave_end().alias("end_date")))


def order_events(spark, sf_dir) -> DataFrame:
    """The four order-derived feeds from ONE scan of ``orders``.

    The scan pushes the OR of the four filters; each order emits one typed
    event per feed it belongs to (``inline`` over an array of optional
    structs), so a status-F urgent order yields both a
    vacation and a leave event.  Columns: see ``HRModel.events``.
    """
    f = _feed_filters()
    start, end = _own_period()
    none_date, none_int, none_bool = (F.lit(None).cast("date"), F.lit(None).cast("int"),
                                      F.lit(None).cast("boolean"))

    def event(kind, event_date, end_date, days, notice, with_period):
        return F.when(f[kind], F.struct(
            F.lit(kind).alias("kind"),
            F.col("o_orderkey").cast("long").alias("event_id"),
            event_date.alias("event_date"),
            end_date.alias("end_date"),
            days.alias("vacation_days"),
            notice.alias("notice_ok"),
            (start if with_period else none_date).alias("period_start"),
            (end if with_period else none_date).alias("period_end")))

    d = _order_date()
    events = F.array(
        event("vacation", none_date, none_date, _vacation_days(), none_bool, True),
        event("hire", d, none_date, none_int, none_bool, False),
        event("termination", d, none_date, none_int, _notice_ok(), False),
        event("leave", d, _leave_end(), none_int, none_bool, False))
    any_feed = f["vacation"] | f["hire"] | f["termination"] | f["leave"]
    # inline of an absent (NULL) struct yields an all-NULL row, dropped next;
    # no higher-order function, so the generator stays in whole-stage codegen
    return (_orders(spark, sf_dir).where(any_feed)
            .select(_order_employee().alias("employee_id"), F.inline(events))
            .where(F.col("kind").isNotNull()))


def exclusions(spark, sf_dir) -> DataFrame:
    """Exclusion list.  ``specific_value`` (abroad only) is c_acctbal / 200."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    kind = (F.when(F.col("c_custkey") % 3 == 0, F.lit(K.EXCLUSION_INTERN))
            .when(F.col("c_custkey") % 3 == 1, F.lit(K.EXCLUSION_APPRENTICE))
            .otherwise(F.lit(K.EXCLUSION_ABROAD)))
    return (cust.where(F.col("c_acctbal") > EXCLUSION_BALANCE)
            .select(F.col("c_custkey").alias("exclusion_id"),
                    (F.col("c_custkey") + 1).cast("long").alias("employee_id"),
                    kind.alias("exclusion_type"),
                    F.when(kind == K.EXCLUSION_ABROAD, F.col("c_acctbal") / 200)
                    .cast("decimal(10,2)").alias("specific_value"),
                    F.lit(None).cast("string").alias("notes")))


def companies(spark) -> DataFrame:
    return spark.sql("SELECT 1L AS company_id, 'Empresa Principal' AS company_name, '00.000.000/0001-00' AS tax_id")


def load_model(spark: SparkSession, sf_dir: str, period: Period = PERIOD) -> HRModel:
    return HRModel(
        spark=spark,
        states=states(spark, sf_dir),
        unions=unions(spark, sf_dir),
        jobs=jobs(spark, sf_dir),
        employees=employees(spark, sf_dir),
        working_days=working_days(spark, sf_dir, period),
        vacations=vacations(spark, sf_dir),
        leaves=leaves(spark, sf_dir),
        terminations=terminations(spark, sf_dir),
        hires=hires(spark, sf_dir),
        exclusions=exclusions(spark, sf_dir),
        companies=companies(spark),
        events=order_events(spark, sf_dir),
        period=period,
        # regions and nations have a fixed cardinality in this schema
        bounds={"states": 5, "unions": 25, "working_days": 25, "companies": 1},
    )
