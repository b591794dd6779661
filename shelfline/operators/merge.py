"""Table-change semantics as DataFrame compositions.

The sinks in :mod:`shelfline.sinks` write these results; tests and oracle
queries use them directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_by_key


def upsert(target: DataFrame, source: DataFrame, key: str | list[str], *,
           strict: bool = False) -> DataFrame:
    """Merge on ``key``: a matched target row is replaced by the source row
    (update all), an unmatched source row is inserted (insert all), other
    target rows are kept.

    A source holding two rows for one key is made deterministic by keeping
    the smallest row (``strict=True`` raises instead).  The anti join reads
    only the source's keys; with a daily source that side is small and the
    big target is not shuffled."""
    keys = [key] if isinstance(key, str) else list(key)
    if strict:
        dup = source.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"merge source has several rows for key {dup[0][:-1]}")
    else:
        source = dedup_by_key(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def replace_partitions(target: DataFrame, source: DataFrame, partition_col: str = "date") -> DataFrame:
    """Dynamic partition overwrite: every partition value present in source
    is replaced by the source rows, the other partitions are kept."""
    present = source.select(partition_col).distinct()
    kept = target.join(present, partition_col, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def append_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source.select(*target.columns))
