"""Text rules: job category and header clean-up."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

from lunchbox import constants as K


def job_category_sql(title: str) -> str:
    """Category of a job title (SQL): first matching keyword on the
    upper-cased title; a NULL title contains no keyword -> FUNCIONARIO."""
    t = f"upper(coalesce(CAST({title} AS STRING), ''))"
    director = " OR ".join(f"contains({t}, '{w}')" for w in K.DIRECTOR_KEYWORDS)
    return (f"CASE WHEN contains({t}, '{K.CATEGORY_INTERN}') THEN '{K.CATEGORY_INTERN}' "
            f"WHEN contains({t}, '{K.CATEGORY_APPRENTICE}') THEN '{K.CATEGORY_APPRENTICE}' "
            f"WHEN {director} THEN '{K.CATEGORY_DIRECTOR}' "
            f"ELSE '{K.CATEGORY_EMPLOYEE}' END")


def job_category(title: str) -> Column:
    """Category of the job title in column ``title`` (see ``job_category_sql``)."""
    return F.expr(job_category_sql(title))


def clean_header(name: str) -> str:
    """Canonical column name for a spreadsheet header.

    Strips surrounding blanks (``'MATRICULA '``), removes accents, upper-cases
    and turns runs of non-alphanumerics into ``_``.  ``'DIAS DE FÉRIAS'`` ->
    ``'DIAS_DE_FERIAS'``; ``'Unnamed: 2'`` -> ``'UNNAMED_2'``.
    """
    plain = unicodedata.normalize("NFKD", name.strip())
    plain = "".join(c for c in plain if not unicodedata.combining(c))
    return re.sub(r"[^0-9A-Za-z]+", "_", plain).strip("_").upper()
