"""Fact reads chosen by attributes of a dimension (F4, F5, J11): the fact is joined on
its partition column, so the days that the dimension's filter leaves are known before
the scan and only their partitions are read (dynamic partition pruning)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fact_of_dates(fact: DataFrame, dim_date: DataFrame, chosen: Column | str, attributes: tuple[str, ...] = ()) -> DataFrame:
    """The fact rows of the days for which ``chosen`` (a condition over ``dim_date``) holds, with
    ``attributes`` of the day.  ``fact`` must be read from a table partitioned by
    ``date``; dim_date has one row per calendar day, so it is safe to broadcast."""
    days = dim_date.where(chosen).select(F.col("date").alias("_day"), *attributes)
    return fact.join(F.broadcast(days), F.col("date") == F.col("_day")).drop("_day")


def revenue_by(fact: DataFrame, dim_date: DataFrame, chosen: Column | str, by: tuple[str, ...]) -> DataFrame:
    """Revenue, items and fact rows of the chosen days by attributes of the day and store.
    The fact is summed by day and store before the attributes are attached to it."""
    days = dim_date.where(chosen).select(F.col("date").alias("_day"), *by)
    sums = fact.join(F.broadcast(days.select("_day")), F.col("date") == F.col("_day")).groupBy("date", "store_id").agg(
        F.sum("line_amount").alias("amount"), F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("rows"))
    return sums.join(F.broadcast(days), F.col("date") == F.col("_day")).groupBy(*by, "store_id").agg(
        F.sum("amount").alias("revenue"), F.sum("quantity").alias("items"), F.sum("rows").alias("fact_rows"))
