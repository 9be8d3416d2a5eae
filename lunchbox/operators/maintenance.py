"""Retention: keep recent rows, delete old ones.

The filters say which rows stay; ``purge_results`` and ``purge_vacations`` delete the others from stored tables.  Those are
partitioned by year and month, so whole months go by dropping their folders, and only the month of the cut-off is written again.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lunchbox.sources.history import files_of


def retain_results(results: DataFrame, min_year: int, min_month: int = 1) -> DataFrame:
    """Results from a year and month on (rows of earlier ones are deleted)."""
    return results.where(F.col("period_year") * 12 + F.col("period_month") >= F.lit(min_year * 12 + min_month))


def retain_recent_results(results: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    """Results of the last ``months`` months before ``as_of`` (rolling window)."""
    cutoff = as_of.year * 12 + (as_of.month - 1) - months
    idx = F.col("period_year") * 12 + (F.col("period_month") - 1)
    return results.where(idx >= F.lit(cutoff))


def retain_vacations(vacations: DataFrame, before: dt.date) -> DataFrame:
    """Vacation rows still relevant: period ends on or after ``before``."""
    return vacations.where(F.col("period_end") >= F.lit(before))


def write_vacations(vacations: DataFrame, path: str) -> None:
    """Vacations stored by year and month of their period's end; only the months that are written are replaced."""
    months = vacations.withColumns({"end_year": F.year("period_end"), "end_month": F.month("period_end")})
    months.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("end_year", "end_month").parquet(path)


def _months(spark: SparkSession, path: str, year: str, month: str) -> list[tuple[int, int, object]]:
    """(year, month, folder) of a stored table's partitions."""
    files, _ = files_of(spark, path)
    found = files.globStatus(files_of(spark, f"{path.rstrip('/')}/{year}=*/{month}=*")[1]) or []
    folders = [f.getPath() for f in found]
    return [(int(p.getParent().getName().split("=")[1]), int(p.getName().split("=")[1]), p) for p in folders]


def _purge(spark: SparkSession, path: str, names: tuple[str, str], first: tuple[int, int], stays: Column | None = None) -> int:
    """Delete what is before month ``first``, and of that month the rows that don't stay; the number of months that were touched.

    Dropping a folder can be repeated.  The month of the cut-off is written beside the table and then put in place by dynamic
    partition overwrite: a lost job leaves it whole, and running again finishes the work.
    """
    files, _ = files_of(spark, path)
    touched = 0
    for year, month, folder in _months(spark, path, *names):
        if (year, month) < first:
            files.delete(folder, True)
            touched += 1
        elif (year, month) == first and stays is not None:
            own = spark.read.parquet(path).where((F.col(names[0]) == year) & (F.col(names[1]) == month))
            if own.where(~stays).isEmpty():
                continue
            stage = f"{path.rstrip('/')}-retention-{uuid.uuid4().hex}"
            own.where(stays).write.parquet(stage)
            kept = spark.read.schema(own.schema).parquet(stage)
            if kept.isEmpty():
                files.delete(folder, True)
            else:
                kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(path)
            files.delete(files_of(spark, stage)[1], True)
            touched += 1
    return touched


def purge_results(spark: SparkSession, path: str, min_year: int, min_month: int = 1) -> int:
    """Delete stored results (``sinks.write_results``) of months before the given one."""
    return _purge(spark, path, ("period_year", "period_month"), (min_year, min_month))


def purge_vacations(spark: SparkSession, path: str, before: dt.date) -> int:
    """Delete stored vacations (``write_vacations``) whose period ended before a date."""
    return _purge(spark, path, ("end_year", "end_month"), (before.year, before.month), F.col("period_end") >= F.lit(before))
