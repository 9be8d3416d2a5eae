"""Writers.  Every write is idempotent: a re-run (or a retried task after an
executor loss) replaces exactly the partitions it produces."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lunchbox import constants as K


LAYOUT_COLUMNS = ["registration", "admission", "union_name", "period_label", "days", "daily_value",
                  "total", "company_cost", "employee_discount", "notes"]


def display_layout(layout: DataFrame) -> DataFrame:
    """English layout columns -> the purchase sheet's display headers."""
    return layout.select([F.col(c).alias(h) for c, h in zip(LAYOUT_COLUMNS, K.PURCHASE_HEADERS)])


def sheet_name(period_label: F.Column) -> F.Column:
    """Tab name: 'VR MENSAL MM.YYYY'."""
    return F.concat(F.lit(K.SHEET_TAB.split("{}")[0]), F.regexp_replace(period_label, "/", "."))


def purchase_layout(layout: DataFrame) -> DataFrame:
    """Layout plus the sheet (tab) each row belongs to."""
    return layout.withColumn("sheet", sheet_name(F.col("period_label")))


def check_exportable(df: DataFrame | None) -> bool:
    """Export guard: None is an error; an empty frame is allowed (written empty).

    Returns False for an empty frame so the caller can warn.
    """
    if df is None:
        raise ValueError("nothing to export: the purchase frame is None")
    return not df.isEmpty()


PERIOD_KEYS = ["period_start", "period_end"]


def write_purchase_sheet(layout: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the sheet, one partition a period (dynamic overwrite).

    Two periods may end in the same month and so share a tab name; the period's
    dates are the partition, and the tab (``sheet``) is an ordinary column.
    """
    headers = [F.col(c).alias(h) for c, h in zip(LAYOUT_COLUMNS, K.PURCHASE_HEADERS)]
    out = layout.select(*headers, sheet_name(F.col("period_label")).alias("sheet"), *PERIOD_KEYS)
    writer = (out.write.mode("overwrite").partitionBy(*PERIOD_KEYS)
              .option("partitionOverwriteMode", "dynamic"))
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def write_results(results: DataFrame, path: str) -> None:
    """Stored results keyed by (employee, year, month); a period re-run replaces
    its own partition only (idempotent upsert).  The write fails, and leaves
    what is stored, if an employee has two rows for a year and month, as of two periods
    that end in the same month."""
    key = ["employee_id", "period_year", "period_month"]
    once = results.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    bad = F.concat_ws(" ", F.lit("two results for employee, year, month:"), *key)
    checked = once.where(F.when(F.col("_n") > 1, F.raise_error(bad).cast("boolean")).otherwise(F.lit(True))).drop("_n")
    (checked.write.mode("overwrite").partitionBy("period_year", "period_month")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    """Normalised table write (replaces the whole table)."""
    df.write.mode("overwrite").parquet(path)
