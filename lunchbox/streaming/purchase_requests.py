"""Incremental purchase runs driven by a stream of period requests.

Operations drop small request files (JSON lines ``{"period_start": ...,
"period_end": ...}``) into a folder as each accounting period closes.  A
file-source stream picks them up; every micro-batch computes the purchase for
the requested periods with the ordinary batch plan and overwrites exactly
those periods' partitions (dynamic partition overwrite), so a replayed batch
-- after a driver or executor failure -- rewrites the same partitions with the
same rows.  Progress lives in the checkpoint location, which must be a shared
folder on a cluster.

The only values brought to the driver are the requested period dates
(control data, streamed in chunks), never employee data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lunchbox.operators import calc
from lunchbox.periods import Period
from lunchbox.sources import sinks
from lunchbox.sources.model import HRModel

REQUEST_SCHEMA = "period_start date, period_end date"
PERIODS_PER_RUN = 24   # periods computed by one plan; more requests -> more runs


def _period_chunks(batch: DataFrame):
    """Distinct requested periods in date order, streamed to the driver in
    chunks (``toLocalIterator``), never all at once."""
    rows = (batch.where(F.col("period_start").isNotNull() & F.col("period_end").isNotNull())
            .select("period_start", "period_end").distinct()
            .orderBy("period_start", "period_end").toLocalIterator())
    chunk: list[Period] = []
    for r in rows:
        chunk.append(Period(r.period_start, r.period_end))
        if len(chunk) == PERIODS_PER_RUN:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def write_batch(model: HRModel, periods: list[Period], sink: str) -> None:
    sinks.write_purchase_sheet(calc.monthly_purchase(model, periods, with_period=True), sink, "parquet")


def start(spark: SparkSession, requests: str, sink: str, checkpoint: str,
          model_of: Callable[[SparkSession], HRModel], available_now: bool = True) -> StreamingQuery:
    """Start the request stream; ``available_now`` processes what is there and stops."""
    stream = spark.readStream.schema(REQUEST_SCHEMA).json(requests)

    def run(batch: DataFrame, batch_id: int) -> None:
        model = model_of(batch.sparkSession)
        for periods in _period_chunks(batch):
            write_batch(model, periods, sink)

    writer = (stream.writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
