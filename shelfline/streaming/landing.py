"""Run the daily jobs for the sale dates whose raw files arrived since the
previous run."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..config import RAW_TX
from ..plans import jobs
from ..session import fresh_path
from ..sources.layout import Lake


def process_new_days(spark: SparkSession, lake: Lake, *, checkpoint: str | None = None,
                     version: str | None = None, median_method: str = "approx", cap=None) -> list:
    """Process every newly landed day once, then stop (availableNow).

    ``checkpoint`` must be a shared folder kept between runs (by default a new
    one below the session's scratch folder, which processes everything).  A
    day landed again (replaced by a rerun of the daily ingest) is processed
    again; the daily jobs replace their partitions, so that is safe.
    Returns the dates processed, in order."""
    raw = lake.table(RAW_TX, "sales")
    schema = spark.read.parquet(raw).schema
    checkpoint = checkpoint or fresh_path(spark, "landing-checkpoint")
    processed: list = []

    def run_batch(batch, batch_id):
        # one row per landed day: the driver only sees the list of dates
        days = sorted(r.date for r in batch.select("date").distinct().collect())
        for d in days:
            jobs.transform_daily(spark, lake, day=d, version=version, median_method=median_method, cap=cap)
            jobs.model_daily(spark, lake, day=d)
            jobs.aggregate_daily(spark, lake, day=d)
        processed.extend(days)

    q = (spark.readStream.schema(schema).parquet(raw)
         .writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return processed
