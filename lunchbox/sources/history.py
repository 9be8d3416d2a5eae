"""A stored snapshot that is merged, not rewritten: only partitions with changed keys are written again.

Rows are dealt to ``BUCKETS`` partitions by a hash of their key and carry a hash of their values and the time of their last change.
A merge compares hashes, finds the buckets that hold new or changed keys, and replaces those; rows that didn't change keep their
stamp, wherever they are.  The new content of a bucket is written beside the table first and then put in place by Spark's
dynamic partition overwrite, so a job that is lost before its commit leaves the table as it was and can be repeated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 64
_BUCKET, _HASH, STAMP = "bucket", "row_hash", "updated_at"


def files_of(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _keyed(df: DataFrame, key: str) -> DataFrame:
    values = [c for c in df.columns if c != key]
    # NULL, and which column holds what, count: a struct as JSON keeps both apart
    return df.withColumns({_HASH: F.xxhash64(F.to_json(F.struct(*values), {"ignoreNullFields": "false"})),
                           _BUCKET: F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")})


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows and their stamps."""
    return spark.read.parquet(path).drop(_BUCKET, _HASH)


def merge_snapshot(spark: SparkSession, path: str, new: DataFrame, key: str, as_of: Column) -> dict[str, int]:
    """Merge ``new`` (one row a key) into the snapshot at ``path``; rows that ``new`` lacks stay.

    Returns the numbers of inserted and updated rows and of rewritten buckets.
    """
    files, at = files_of(spark, path)
    fresh = _keyed(new, key)
    if not files.exists(at):
        fresh.withColumn(STAMP, as_of).repartition(BUCKETS, _BUCKET).write.partitionBy(_BUCKET).parquet(path)
        n = spark.read.parquet(path).count()
        return {"inserted": n, "updated": 0, "buckets": BUCKETS}
    stored = spark.read.parquet(path)
    stage = f"{path.rstrip('/')}-merge-{uuid.uuid4().hex}"
    try:
        old = stored.select(key, F.col(_HASH).alias("_old"))
        changed = fresh.join(old, key, "left").where(~F.col(_HASH).eqNullSafe(F.col("_old")))
        changed.withColumn("_inserted", F.col("_old").isNull()).drop("_old").write.parquet(f"{stage}/changed")
        delta = spark.read.parquet(f"{stage}/changed")
        counts = delta.groupBy(_BUCKET).agg(F.count("*").alias("n"), F.count_if("_inserted").alias("inserted")).collect()  # BUCKETS rows at most
        buckets = [r[_BUCKET] for r in counts]
        if buckets:
            kept = stored.where(F.col(_BUCKET).isin(buckets)).join(delta.select(key), key, "left_anti")  # prunes to those buckets
            delta.drop("_inserted").withColumn(STAMP, as_of).unionByName(kept).write.parquet(f"{stage}/rows")
            out = spark.read.parquet(f"{stage}/rows").repartition(len(buckets), _BUCKET)
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
        inserted = sum(r.inserted for r in counts)
        return {"inserted": inserted, "updated": sum(r.n for r in counts) - inserted, "buckets": len(buckets)}
    finally:
        files.delete(files_of(spark, stage)[1], True)
