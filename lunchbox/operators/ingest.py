"""Ingest: sheet feeds -> typed, resolved model tables.

Each step is a join or a column expression; registration lookups are one
join per feed (never a lookup per row), and unmatched rows are dropped the
way loading drops them (``dq_unmatched`` counts them).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lunchbox import constants as K
from lunchbox.functions.keys import lookup_join, sorted_surrogate_ids
from lunchbox.functions.text import clean_header, job_category


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename sheet headers to canonical names (see ``clean_header``)."""
    return df.toDF(*[clean_header(c) for c in df.columns])


def cast_checked(df: DataFrame, types: dict[str, str], strict: bool = False,
                 error_col: str = "cast_errors") -> DataFrame:
    """Cast columns to the given types.

    ``strict=True``: a malformed value fails the job (ANSI cast), as a
    malformed cell aborts a load.  Otherwise ``try_cast`` keeps the row, sets
    the value to NULL and lists the offending columns in ``error_col`` so the
    caller can quarantine it (``where(size(error_col) > 0)``).
    """
    if strict:
        return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    casted = {c: F.try_cast(F.col(c), t) if hasattr(F, "try_cast") else F.expr(f"try_cast(`{c}` AS {t})")
              for c, t in types.items()}
    failed = [F.when(F.col(c).isNotNull() & casted[c].isNull(), F.lit(c)) for c in types]
    return (df.withColumn(error_col, F.filter(F.array(*failed), lambda x: x.isNotNull()))
            .withColumns(casted))


def job_titles(*title_columns: tuple[DataFrame, str]) -> DataFrame:
    """Distinct non-null titles over several sheets (``title`` column)."""
    parts = [df.select(F.col(f"`{c}`").cast("string").alias("title")) for df, c in title_columns]
    return reduce(DataFrame.unionByName, parts).where(F.col("title").isNotNull()).distinct()


def job_dim(titles: DataFrame) -> DataFrame:
    """Jobs numbered from 1 in title order, with their category."""
    return (sorted_surrogate_ids(titles, "title", "job_id")
            .withColumn("category", job_category("title"))
            .select("job_id", "title", "category"))


def lookup_with_default(df: DataFrame, name_col: str, dim: DataFrame, dim_name: str,
                        dim_id: str, out_col: str, default_id: int = 1, salt_by: str | None = None) -> DataFrame:
    """Exact-name lookup; an unknown or NULL name silently becomes ``default_id``.

    Adds ``out_col`` and a boolean ``<out_col>_matched`` so the silent default
    stays visible to data-quality reports.
    """
    keyed = dim.select(F.col(dim_name).alias("_name"), F.col(dim_id).alias("_id"))
    joined = lookup_join(df.withColumn("_name", F.col(name_col)), keyed, "_name", "left", salt_by)
    return (joined.withColumn(out_col, F.coalesce(F.col("_id"), F.lit(default_id)).cast("long"))
            .withColumn(f"{out_col}_matched", F.col("_id").isNotNull())
            .drop("_name", "_id"))


def resolve_registrations(feed: DataFrame, employees: DataFrame,
                          registration_col: str = "registration") -> DataFrame:
    """Attach ``employee_id`` by registration; rows with no employee are dropped."""
    emp = employees.select(F.col("registration").alias("_reg"), "employee_id")
    return (feed.join(emp, feed[registration_col] == emp["_reg"], "inner")
            .drop("_reg"))


def with_dates(df: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
               names: tuple[str, str] = ("period_start", "period_end")) -> DataFrame:
    """Start and end date of each row: the sheet's own (INICIO, FIM) where it has them, else those of the load."""
    own = lambda c: F.col(c).cast("date") if c in df.columns else F.lit(None).cast("date")
    out = df.withColumn(names[0], F.coalesce(own("INICIO"), F.lit(start).cast("date")))
    return out.withColumn(names[1], F.when(own("INICIO").isNotNull(), own("FIM")).otherwise(F.lit(end).cast("date")))


def notice_flag(text: Column) -> Column:
    """Notice column is exactly 'OK' -> True; anything else, NULL included -> False."""
    return F.coalesce(text == F.lit(K.NOTICE_OK_TEXT), F.lit(False))


def exclusions_union(interns: DataFrame, apprentices: DataFrame, abroad: DataFrame) -> DataFrame:
    """Tagged union of the three exclusion sheets (registration-keyed, headers
    normalised).  Duplicates are kept, as loading keeps them."""
    a = interns.select(F.col("MATRICULA").cast("long").alias("registration"),
                       F.lit(K.EXCLUSION_INTERN).alias("exclusion_type"))
    b = apprentices.select(F.col("MATRICULA").cast("long").alias("registration"),
                           F.lit(K.EXCLUSION_APPRENTICE).alias("exclusion_type"))
    c = abroad.select(F.col("CADASTRO").cast("long").alias("registration"),
                      F.lit(K.EXCLUSION_ABROAD).alias("exclusion_type"),
                      F.col("VALOR").cast("decimal(10,2)").alias("specific_value"),
                      F.col("UNNAMED_2").cast("string").alias("notes"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


def backfill_hire_date(employees: DataFrame, hires: DataFrame) -> DataFrame:
    """Fill a NULL employee hire date from the hire feed (first row by load order).

    Only NULLs are filled.  The hire feed is reduced to one row per employee
    (partial + final ``min_by``) before the join, so the join never fans out.
    """
    first = hires.groupBy("employee_id").agg(F.min_by("hire_date", "hire_id").alias("_first_hire"))
    return (employees.join(first, "employee_id", "left")
            .withColumn("hire_date", F.coalesce(F.col("hire_date"), F.col("_first_hire")))
            .drop("_first_hire"))


def upsert_changed(old: DataFrame, new: DataFrame, key: str, compare: list[str],
                   as_of: Column | None = None) -> DataFrame:
    """Merge a new snapshot into an old one, stamping ``updated_at`` on change.

    Full outer join on ``key``: new rows win; rows only in ``old`` are kept;
    ``changed`` is true when any compared column differs (NULL-safe) or the
    row is new.  ``updated_at`` = ``as_of`` for changed rows, else the old
    stamp.
    """
    stamp = as_of if as_of is not None else F.current_timestamp()
    o = old.select(key, *[F.col(c).alias(f"_old_{c}") for c in compare],
                   F.col("updated_at").alias("_old_updated_at") if "updated_at" in old.columns
                   else F.lit(None).cast("timestamp").alias("_old_updated_at"),
                   F.lit(True).alias("_in_old"))
    n = new.select(key, *compare, F.lit(True).alias("_in_new"))
    j = o.join(n, key, "full_outer")
    diff = reduce(lambda a, b: a | b,
                  [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in compare])
    changed = F.col("_in_new").isNotNull() & (F.col("_in_old").isNull() | diff)
    out = j.select(
        key,
        *[F.when(F.col("_in_new").isNotNull(), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c)
          for c in compare],
        changed.alias("changed"),
        F.when(changed, stamp).otherwise(F.col("_old_updated_at")).alias("updated_at"))
    return out
