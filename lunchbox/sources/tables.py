"""The normalised model stored as Parquet tables (one folder per table).

``write_model`` persists a model (the bulk-insert step of loading);
``read_model`` reads it back with fixed schemas -- no inference, column
pruning and filter pushdown as usual.  This is how a production run gets its
base frames.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lunchbox.periods import Period
from lunchbox.sources.builder import SCHEMAS
from lunchbox.sources.model import HRModel
from lunchbox.sources.sinks import write_table

# Dimension bounds verified before broadcast (rows).
DEFAULT_BOUNDS = {"states": 100, "unions": 10_000, "working_days": 1_000_000, "companies": 1_000}


def write_model(model: HRModel, root: str) -> None:
    """Write every table of the model under ``root/<table>`` (overwrite)."""
    for name in SCHEMAS:
        write_table(model.table(name), f"{root.rstrip('/')}/{name}")


def read_model(spark: SparkSession, root: str, period: Period,
               bounds: dict | None = None) -> HRModel:
    """Read a stored model; ``period`` is the default period of the run."""
    tables = {name: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")
              for name, schema in SCHEMAS.items()}
    return HRModel(spark=spark, period=period, bounds=dict(bounds or DEFAULT_BOUNDS), **tables)
