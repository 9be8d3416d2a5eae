"""Session helpers: shared folder, written intermediates, code on the workers."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one is set only where none is (tests)."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="llm-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` does, once an application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), f"lunchbox_{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.llm_path = path
    return out


def freed(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more; other frames are left alone."""
    for table in tables:
        path = getattr(table, "llm_path", None)
        if path:
            at = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def released() -> None:
    """Give memory that a Python worker has freed, but still holds, back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def crc_remainder(column: str, modulus: int):
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named c0, c1, ..., so that names inside an operator can't clash with theirs."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
