"""Load audit as a DataFrame (A10) instead of log lines, by a pass over a table or
as metrics of the write that makes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

AUDIT = StructType([StructField("row_count", LongType(), False), StructField("distinct_dates", LongType(), False),
                    StructField("min_date", DateType()), StructField("max_date", DateType())])


def audit_counts(df: DataFrame, date_col: str = "date") -> DataFrame:
    """rows, distinct dates, first and last date of a table in one pass."""
    d = F.col(date_col)
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(d).alias("distinct_dates"),
                  F.min(d).alias("min_date"), F.max(d).alias("max_date"))


class WriteAudit:
    """The audit of the rows that one write writes, taken while it writes them.

    Give it to a sink as ``observe`` and read :meth:`frame` afterwards.  The sinks
    apply it after their last shuffle, so each row is counted in the task that writes
    it, once, also where lost tasks run again.  A task sends its distinct dates
    (calendar days) and three numbers to the driver.  Without ``date_col`` rows are
    counted only.  One write per audit."""

    def __init__(self, date_col: str | None = "date"):
        self.date_col, self._seen = date_col, Observation()

    def __call__(self, df: DataFrame) -> DataFrame:
        metrics = [F.count(F.lit(1)).alias("row_count")]
        if self.date_col is not None:
            d = F.col(self.date_col)
            metrics += [F.size(F.collect_set(d)).alias("distinct_dates"), F.min(d).alias("min_date"), F.max(d).alias("max_date")]
        return df.observe(self._seen, *metrics)

    @property
    def values(self) -> dict:
        return self._seen.get

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row, with the columns of :func:`audit_counts`."""
        v = self.values
        return spark.createDataFrame([(v["row_count"], v.get("distinct_dates", 0), v.get("min_date"), v.get("max_date"))], AUDIT)
