"""Dense surrogate ids for a key set of any size."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def dense_ids(df: DataFrame, keys: Sequence[str], id_col: str, start: int = 1) -> DataFrame:
    """The distinct ``keys`` of ``df`` with whole-number ids from ``start`` without gaps, in key
    order (nulls first).  Reruns give the same ids wherever the ranges are cut.

    Keys are dealt by range; an id is the count of the ranges before plus the place in
    the own range, so no task sees all keys.  Only a count per range reaches the driver."""
    order = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    ranges = stored(df.select(*keys).distinct().repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "id-ranges")
    counts = sorted(map(tuple, ranges.groupBy("_range").count().collect()))
    offsets = accumulate((n for _, n in counts), initial=start - 1)
    table = df.sparkSession.createDataFrame([(r, o) for (r, _), o in zip(counts, offsets)], "_range int, _offset long")  # noqa: B905
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = ranges.withColumn("_place", place).join(F.broadcast(table), "_range")
    return numbered.select((F.col("_offset") + F.col("_place")).alias(id_col), *keys)
