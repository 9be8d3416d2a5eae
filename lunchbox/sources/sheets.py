"""Sheet-shaped feeds, as the HR spreadsheets deliver them.

Headers keep the sheets' own spelling (accents, a trailing blank in
``'MATRICULA '``, an unnamed third column); values are typed the way a
spreadsheet reader would infer them.  :mod:`lunchbox.operators.ingest` turns
them into the model.  Here they are derived from the driver's tables with the
same mapping as :mod:`lunchbox.sources.testdata` (from the model's lazy
table definitions); in production they are read with :func:`read_sheet`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lunchbox import constants as K
from lunchbox.functions.keys import checked_broadcast
from lunchbox.operators.joins import employee_jobs
from lunchbox.sources import testdata as T
from lunchbox.sources.model import HRModel


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", schema=None, **options) -> DataFrame:
    """Read one exported sheet (CSV with header, or Parquet).

    Pass an explicit schema in production; without one, columns are read as
    text and typed later by ``operators.ingest.cast_checked``.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def active_sheet(m: HRModel) -> DataFrame:
    uni = m.unions.select("union_id", "union_full_name")
    return (employee_jobs(m, "left").join(checked_broadcast(uni, "unions"), "union_id", "left")
            .select(F.col("registration").alias("MATRICULA"),
                    F.lit("Empresa Principal").alias("EMPRESA"),
                    F.col("job_title").alias("TITULO DO CARGO"),
                    F.col("status").alias("DESC. SITUACAO"),
                    F.col("union_full_name").alias("Sindicato")))


def _registration(col="employee_id"):
    return (F.col(col) - 1 + T.REGISTRATION_BASE).cast("long")


def vacation_sheet(m: HRModel) -> DataFrame:
    v = m.vacations
    return v.select(_registration().alias("MATRICULA"),
                    F.lit(K.STATUS_VACATION).alias("DESC. SITUACAO"),
                    F.col("vacation_days").cast("long").alias("DIAS DE FÉRIAS"),
                    F.col("period_start").alias("INICIO"), F.col("period_end").alias("FIM"))


# fixed values of the projection: the flag cell of a leave by its id's remainder of 4 (3: an empty cell)
LEAVE_FLAGS = ["sim", "N", " S "]


def leave_sheet(m: HRModel) -> DataFrame:
    lv = m.leaves
    kind = F.pmod(F.col("leave_id"), F.lit(4))
    flag = F.when(kind < 3, F.element_at(F.array(*map(F.lit, LEAVE_FLAGS)), (F.least(kind, F.lit(2)) + 1).cast("int")))
    return lv.select(_registration().alias("MATRICULA"),
                     F.col("leave_type").alias("DESC. SITUACAO"),
                     flag.alias("na compra?"),
                     F.col("start_date").alias("INICIO"), F.col("end_date").alias("FIM"))


def termination_sheet(m: HRModel, with_id: bool = False) -> DataFrame:
    t = m.terminations
    return t.select(*([F.col("termination_id").alias("ID")] if with_id else []), _registration().alias("MATRICULA "),
                    F.col("termination_date").cast("timestamp_ntz").alias("DATA DEMISSÃO"),
                    F.when(F.col("notice_ok"), F.lit(K.NOTICE_OK_TEXT))
                    .alias("COMUNICADO DE DESLIGAMENTO"))


def hire_sheet(m: HRModel) -> DataFrame:
    h = m.hires
    emp = employee_jobs(m, "left").select("employee_id", "job_title")
    return (h.join(emp, "employee_id", "left")
            .select(_registration().alias("MATRICULA"),
                    F.col("hire_date").cast("timestamp_ntz").alias("Admissão"),
                    F.col("job_title").alias("Cargo")))


def exclusion_sheets(m: HRModel) -> dict[str, DataFrame]:
    x = m.exclusions
    emp = employee_jobs(m, "left").select("employee_id", "job_title")
    xj = x.join(emp, "employee_id", "left")
    interns = xj.where(F.col("exclusion_type") == K.EXCLUSION_INTERN).select(
        _registration().alias("MATRICULA"), F.col("job_title").alias("TITULO DO CARGO"),
        F.lit(None).cast("string").alias("na compra?"))
    apprentices = xj.where(F.col("exclusion_type") == K.EXCLUSION_APPRENTICE).select(
        _registration().alias("MATRICULA"), F.col("job_title").alias("TITULO DO CARGO"))
    abroad = x.where(F.col("exclusion_type") == K.EXCLUSION_ABROAD).select(
        _registration().alias("Cadastro"), F.col("specific_value").alias("Valor"),
        F.col("notes").alias("Unnamed: 2"))
    return {"interns": interns, "apprentices": apprentices, "abroad": abroad}


def registration_columns(m: HRModel) -> dict[str, tuple[DataFrame, str]]:
    """Registration column of each sheet that is resolved against the employees, without the other cells."""
    facts = {"vacations": m.vacations, "leaves": m.leaves, "terminations": m.terminations, "hires": m.hires}
    kinds = {"interns": K.EXCLUSION_INTERN, "apprentices": K.EXCLUSION_APPRENTICE, "abroad": K.EXCLUSION_ABROAD}
    facts |= {name: m.exclusions.where(F.col("exclusion_type") == kind) for name, kind in kinds.items()}
    return {name: (df.select(_registration().alias("MATRICULA")), "MATRICULA") for name, df in facts.items()}


def text_sheet(df: DataFrame) -> DataFrame:
    """Every column as text (what a CSV export gives)."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
