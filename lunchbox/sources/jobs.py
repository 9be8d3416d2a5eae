"""The stored job table: an append-only dictionary of titles with lasting ids.

Ids are given once.  New titles get ids above the greatest, in title order among themselves, and are appended as files
of their own; nothing that is stored is rewritten, so an id, a title or a category never changes.  Numbering
counts by prefixes (``functions.keys.sorted_surrogate_ids``): a lazy plan, the same for every attempt of a task.  One writer at a
time is assumed, as for any load of the model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lunchbox.functions.keys import sorted_surrogate_ids
from lunchbox.functions.text import job_category

SCHEMA = "job_id long, title string, category string"


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """The job table at ``path``; empty where there is none yet."""
    files, at = _path(spark, path)
    if not files.exists(at):
        return spark.sql("SELECT CAST(NULL AS BIGINT) AS job_id, CAST(NULL AS STRING) AS title, CAST(NULL AS STRING) AS category WHERE FALSE")
    return spark.read.schema(SCHEMA).parquet(path)


def extend_jobs(spark: SparkSession, path: str, titles: DataFrame) -> DataFrame:
    """Append the titles that the table at ``path`` lacks (``titles``: title), with their category; returns the whole table."""
    stored = read_jobs(spark, path)
    greatest = stored.agg(F.max("job_id")).first()[0] or 0  # the append is an action anyway
    new = titles.where(F.col("title").isNotNull()).select("title").distinct().join(stored.select("title"), "title", "left_anti")
    numbered = sorted_surrogate_ids(new, "title", "job_id", after=greatest)
    numbered.select("job_id", "title", job_category("title").alias("category")).write.mode("append").parquet(path)
    return read_jobs(spark, path)
