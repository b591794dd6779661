"""Digests of a table by day, which tell the days that differ from what was processed
(W3, L5, L7, L9 for changed days)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_digests(df: DataFrame, date_col: str = "date") -> DataFrame:
    """date, row_count, digest: one row per day, the same for the same rows in any order.

    The digest is the sum of the rows' hashes, so repeated rows count; nulls are
    hashed with their place.  Sums are partial in each task and a day is one row of
    the shuffle, however many sales it has."""
    own = [F.col(f"`{c}`") for c in df.columns if c != date_col]
    row = F.xxhash64(*own, *[c.isNull() for c in own]) if own else F.lit(0).cast("long")
    return df.select(F.col(date_col).alias("date"), row.cast("decimal(20,0)").alias("h")).groupBy("date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("h").alias("digest"))


def changed_days(now: DataFrame, kept: DataFrame) -> DataFrame:
    """date, status (``new``, ``gone`` or ``changed``) of the days whose digests differ."""
    n, k = now.alias("n"), kept.alias("k")
    both = n.join(k, F.col("n.date").eqNullSafe(F.col("k.date")), "full_outer")
    status = (F.when(F.col("k.row_count").isNull(), "new").when(F.col("n.row_count").isNull(), "gone")
              .when((F.col("n.row_count") != F.col("k.row_count")) | (F.col("n.digest") != F.col("k.digest")), "changed"))
    return both.select(F.coalesce("n.date", "k.date").alias("date"), status.alias("status")).where("status is not null")
