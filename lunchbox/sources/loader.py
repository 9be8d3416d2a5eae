"""From a folder of exported sheets to the stored model, with a quarantine table for each feed.

The folder holds eight sheets and three dimension tables as CSV files with a header:

    ativos.csv  ferias.csv  afastamentos.csv  desligados.csv  admissoes.csv  estagiarios.csv  aprendizes.csv  exterior.csv
    states.csv  unions.csv  working_days.csv

Headers may be padded or accented (``'MATRICULA '``, ``'DIAS DE FÉRIAS'``); columns come in any order and further ones are left
alone.  Every feed is read once as text, typed by ``try_cast`` and judged row by row.  Good rows go to the model, the others to
``<model>/quarantine/<feed>`` with the row as it was read, its file and the reasons:

* ``malformed row``: the line has more or fewer cells than the header
* ``bad <column>: <cell>``: a cell that isn't of its type, or is missing where it must not be
* ``repeated registration``: an employee's row after the first one of its registration
* ``unknown registration``: a feed's row whose registration no good employee row has

No row is dropped silently: a feed's model rows and quarantined rows add up to its sheet.  An unknown job or union isn't an
error and becomes id 1; ids of jobs come from the append-only job table (``sources.jobs``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lunchbox import constants as K
from lunchbox.functions.keys import lookup_join
from lunchbox.functions.text import clean_header
from lunchbox.operators import ingest
from lunchbox.periods import Period
from lunchbox.sources import jobs as job_table
from lunchbox.sources.builder import SCHEMAS
from lunchbox.sources.model import HRModel
from lunchbox.sources.sinks import write_table
from lunchbox.sources.tables import read_model


@dataclass(frozen=True)
class Sheet:
    """A feed's file and its columns: canonical header -> (name, type, must it be there)."""

    file: str
    columns: dict[str, tuple[str, str, bool]]


# fixed values: headers of the sheets, as they are normalised
SHEETS = {
    "employees": Sheet("ativos.csv", {
        "MATRICULA": ("registration", "bigint", True), "TITULO_DO_CARGO": ("job_title", "string", False),
        "DESC_SITUACAO": ("status", "string", True), "SINDICATO": ("union_full_name", "string", False)}),
    "vacations": Sheet("ferias.csv", {"MATRICULA": ("registration", "bigint", True), "DIAS_DE_FERIAS": ("vacation_days", "int", True)}),
    "leaves": Sheet("afastamentos.csv", {"MATRICULA": ("registration", "bigint", True), "DESC_SITUACAO": ("leave_type", "string", False)}),
    "terminations": Sheet("desligados.csv", {
        "MATRICULA": ("registration", "bigint", True), "DATA_DEMISSAO": ("termination_date", "date", True),
        "COMUNICADO_DE_DESLIGAMENTO": ("notice", "string", False)}),
    "hires": Sheet("admissoes.csv", {
        "MATRICULA": ("registration", "bigint", True), "ADMISSAO": ("hire_date", "date", True), "CARGO": ("job_title", "string", False)}),
    "interns": Sheet("estagiarios.csv", {"MATRICULA": ("registration", "bigint", True), "TITULO_DO_CARGO": ("job_title", "string", False)}),
    "apprentices": Sheet("aprendizes.csv", {"MATRICULA": ("registration", "bigint", True), "TITULO_DO_CARGO": ("job_title", "string", False)}),
    "abroad": Sheet("exterior.csv", {
        "CADASTRO": ("registration", "bigint", True), "VALOR": ("specific_value", "decimal(10,2)", False), "UNNAMED_2": ("notes", "string", False)}),
}
#: columns that a sheet may have: a row's own dates instead of the load's
OWN_DATES = {"vacations": ("period_start", "period_end"), "leaves": ("start_date", "end_date")}
DIMENSIONS = ("states", "unions", "working_days")
EXCLUSIONS = {"interns": K.EXCLUSION_INTERN, "apprentices": K.EXCLUSION_APPRENTICE, "abroad": K.EXCLUSION_ABROAD}
_LOST = "_malformed"


def read_feed(spark: SparkSession, folder: str, feed: str) -> DataFrame:
    """A sheet as text under canonical headers, with ``row`` (as read), ``file``, ``load_id`` (order in the file) and ``malformed``."""
    path = f"{folder.rstrip('/')}/{SHEETS[feed].file}"
    options = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LOST, "ignoreLeadingWhiteSpace": "false"}
    headers = spark.read.options(**options).csv(path).columns  # the first line only
    missing = [c for c in SHEETS[feed].columns if c not in map(clean_header, headers)]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    names = [f"c{i}" for i in range(len(headers))]
    raw = spark.read.options(**options).schema(", ".join([*(f"{n} string" for n in names), f"{_LOST} string"])).csv(path)
    row = F.coalesce(F.col(_LOST), F.concat_ws(",", *(F.coalesce(F.col(n), F.lit("")) for n in names)))
    out = raw.select(*names, row.alias("row"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("load_id"),
                     F.col(_LOST).isNotNull().alias("malformed"))
    return out.withColumnsRenamed({n: clean_header(h) for n, h in zip(names, headers)})


def _typed(text: Column, kind: str) -> Column:
    """A cell as its type, NULL where it isn't of it; dates also as dd/mm/yyyy or with a time."""
    clean = F.trim(text)
    if kind == "date":
        return F.coalesce(F.try_to_date(clean, "dd/MM/yyyy"), clean.try_cast("timestamp_ntz").cast("date"))
    return clean if kind == "string" else clean.try_cast(kind)


def judged(raw: DataFrame, feed: str) -> DataFrame:
    """The typed columns of a feed, ``row``, ``file``, ``load_id`` and ``reasons`` (empty for a good row)."""
    columns = dict(SHEETS[feed].columns)
    if feed in OWN_DATES:
        columns |= {h: (h, "date", False) for h in ("INICIO", "FIM") if h in raw.columns}
    reasons = [F.when(F.col("malformed"), F.lit("malformed row"))]
    for header, (_, kind, needed) in columns.items():
        cell, value = F.col(header), _typed(F.col(header), kind)
        there = F.trim(cell) != ""
        bad = value.isNull() & (F.lit(True) if needed else F.coalesce(there, F.lit(False)))
        reasons.append(F.when(~F.col("malformed") & bad, F.concat(F.lit(f"bad {header}: "), F.coalesce(cell, F.lit("")))))
    typed = [F.nullif(_typed(F.col(h), k), F.lit("")).alias(n) if k == "string" else _typed(F.col(h), k).alias(n) for h, (n, k, _) in columns.items()]
    return raw.select(*typed, "row", "file", "load_id", F.array_compact(F.array(*reasons)).alias("reasons"))


def _no_repeats(rows: DataFrame) -> DataFrame:
    """Employees with a reason for every row after the first good one of a registration."""
    good = F.size("reasons") == 0
    first = rows.where(good).groupBy(F.col("registration").alias("_r")).agg(F.min("load_id").alias("_first"))  # one row a registration and task
    joined = rows.join(first, rows["registration"] == first["_r"], "left")
    again = good & (F.col("load_id") > F.col("_first"))
    return joined.withColumn("reasons", F.when(again, F.array(F.lit("repeated registration"))).otherwise(F.col("reasons"))).drop("_r", "_first")


def _resolved(rows: DataFrame, employees: DataFrame) -> DataFrame:
    """A feed's rows with ``employee_id``, or the reason that there is none."""
    known = employees.select(F.col("registration").alias("_r"), "employee_id")
    joined = rows.join(known, rows["registration"] == known["_r"], "left").drop("_r")
    lost = (F.size("reasons") == 0) & F.col("employee_id").isNull()
    return joined.withColumn("reasons", F.when(lost, F.array(F.lit("unknown registration"))).otherwise(F.col("reasons")))


def load_sheets(spark: SparkSession, folder: str, root: str, period: Period, leave_start: dt.date | None = None) -> HRModel:
    """Load the sheets of ``folder`` into the model tables under ``root``; returns the stored model.

    Vacations without dates of their own get the period's, leaves ``leave_start`` (or the period's start) and an open end.  The judged rows of
    every feed are written once, so the model and the quarantine come from the same reading.
    """
    root = root.rstrip("/")
    staged: dict[str, DataFrame] = {}

    def stage(name: str, rows: DataFrame) -> None:
        path = f"{root}/staging/{name}"
        rows.write.mode("overwrite").parquet(path)
        staged[name] = spark.read.schema(rows.schema).parquet(path)

    stage("employees", _no_repeats(judged(read_feed(spark, folder, "employees"), "employees")))
    good = lambda name: staged[name].where(F.size("reasons") == 0)
    ids = good("employees").select("registration", F.col("registration").alias("employee_id"))  # the registration is the employee's lasting id
    for feed in SHEETS:
        if feed != "employees":
            stage(feed, _resolved(judged(read_feed(spark, folder, feed), feed), ids))

    titles = ingest.job_titles(*((good(f), "job_title") for f in ("employees", "hires", "interns", "apprentices")))
    jobs = job_table.extend_jobs(spark, f"{root}/jobs", titles)
    for name in DIMENSIONS:
        text = spark.read.option("header", "true").csv(f"{folder.rstrip('/')}/{name}.csv")
        text = text.toDF(*(c.strip() for c in text.columns))
        fields = [f.strip().rsplit(" ", 1) for f in SCHEMAS[name].replace(", ", ",").replace("(10,2)", "(10;2)").split(",")]
        write_table(text.select(*(F.trim(c).cast(k.replace(";", ",")).alias(c) for c, k in fields)), f"{root}/{name}")  # a bad dimension cell fails the load
    unions = spark.read.schema(SCHEMAS["unions"]).parquet(f"{root}/unions")

    emp = good("employees")
    emp = lookup_join(emp.withColumnRenamed("job_title", "title"), jobs.select("title", "job_id"), "title", "left", salt_by="registration")
    emp = lookup_join(emp, unions.select("union_full_name", "union_id"), "union_full_name", "left", salt_by="registration")
    excluded = None
    for feed, kind in EXCLUSIONS.items():
        rows = good(feed)
        value = F.col("specific_value") if "specific_value" in rows.columns else F.lit(None)
        notes = F.col("notes") if "notes" in rows.columns else F.lit(None)
        part = rows.select(F.col("load_id").alias("exclusion_id"), "employee_id", F.lit(kind).alias("exclusion_type"),
                           value.cast("decimal(10,2)").alias("specific_value"), notes.cast("string").alias("notes"))
        excluded = part if excluded is None else excluded.unionByName(part)
    own = OWN_DATES
    tables = {
        "employees": emp.select(
            F.col("registration").alias("employee_id"), "registration", F.lit(1).cast("long").alias("company_id"),
            F.coalesce("job_id", F.lit(1)).cast("long").alias("job_id"), F.coalesce("union_id", F.lit(1)).cast("long").alias("union_id"),
            "status", F.lit(None).cast("date").alias("hire_date"), F.lit(None).cast("date").alias("termination_date")),
        "vacations": ingest.with_dates(good("vacations"), period.start, period.end, own["vacations"]).select(
            F.col("load_id").alias("vacation_id"), "employee_id", *own["vacations"], "vacation_days"),
        "leaves": ingest.with_dates(good("leaves"), leave_start or period.start, None, own["leaves"]).select(
            F.col("load_id").alias("leave_id"), "employee_id", "leave_type", *own["leaves"]),
        "terminations": good("terminations").select(
            F.col("load_id").alias("termination_id"), "employee_id", "termination_date", ingest.notice_flag(F.col("notice")).alias("notice_ok")),
        "hires": good("hires").select(F.col("load_id").alias("hire_id"), "employee_id", "hire_date"),
        "exclusions": excluded,
        "companies": spark.sql("SELECT 1L AS company_id, 'Empresa Principal' AS company_name, CAST(NULL AS STRING) AS tax_id"),
    }
    for name, df in tables.items():
        write_table(df, f"{root}/{name}")
    for feed, rows in staged.items():
        write_table(rows.where(F.size("reasons") > 0).select("row", "file", F.concat_ws("; ", "reasons").alias("reason")), f"{root}/quarantine/{feed}")
    return read_model(spark, root, period)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """(feed, row, file, reason) of all feeds."""
    parts = [spark.read.schema("row string, file string, reason string").parquet(f"{root.rstrip('/')}/quarantine/{feed}").select(F.lit(feed).alias("feed"), "*")
             for feed in SHEETS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
