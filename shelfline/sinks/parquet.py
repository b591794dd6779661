"""Parquet writers.

Before a partitioned write the rows are rebalanced on the partition columns
(REBALANCE hint): each partition value lands in few tasks, so a day is a few
files instead of one file per task, and adaptive execution splits a hot day
over several tasks instead of sending it to one.  ``rows``, about how many there are,
lets many of them be shuffled as compressed batches (:mod:`~shelfline.operators.dealing`).

``placed`` says that the rows of a partition value lie in few tasks already (they were
read from such folders, or shuffled by them): they are written without that shuffle.

Files are compressed by zstd.  The shuffle files of a write are removed when it ends.

``observe`` (a function of a DataFrame, such as an ``operators.audit.WriteAudit``) is
applied to the rows as they are written, after that shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.dealing import balanced
from ..session import shuffles_removed

Observe = Callable[[DataFrame], DataFrame]
CODEC = "zstd"


def _cols(partition_by) -> list[str]:
    if partition_by is None:
        return []
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


def _balanced(df: DataFrame, cols: Sequence[str], observe: Observe | None = None, placed: bool = False,
              rows: int | None = None) -> DataFrame:
    df = df if placed else balanced(df, cols, rows)
    return observe(df) if observe else df


def write_partitioned(df: DataFrame, path: str, partition_by="date", mode: str = "overwrite",
                      observe: Observe | None = None, placed: bool = False, rows: int | None = None) -> None:
    """W1 (overwrite) / W2 (append) of a dataset partitioned by ``partition_by``."""
    cols = _cols(partition_by)
    w = _balanced(df, cols, observe, placed, rows).write.mode(mode).option("compression", CODEC)
    if cols:
        w = w.partitionBy(*cols)
    with shuffles_removed(df.sparkSession):
        w.parquet(path)


def _files(spark: SparkSession, folder: str) -> set[str]:
    try:
        return set(spark.read.parquet(folder).inputFiles())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return set()
        raise


def has_files(spark: SparkSession, folder: str) -> bool:
    return bool(_files(spark, folder))


def replace_partitions(df: DataFrame, path: str, partition_by="date", values=None,
                       observe: Observe | None = None, placed: bool = False) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite) and
    the named ``values``: one of those without rows in ``df`` loses its old rows.
    Rerunning a day gives the same table.

    The write gives every partition present new files, so a named partition that
    still has its old ones had no rows."""
    cols = _cols(partition_by)
    folders = [f"{path.rstrip('/')}/{cols[0]}={v}" for v in values or ()]
    before = [_files(df.sparkSession, f) for f in folders]
    with shuffles_removed(df.sparkSession):
        (_balanced(df, cols, observe, placed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", CODEC).partitionBy(*cols).parquet(path))
    for folder, old in zip(folders, before, strict=True):
        if old and old & _files(df.sparkSession, folder):
            df.where("false").drop(*cols).write.mode("overwrite").parquet(folder)


def write_once(df: DataFrame, path: str, observe: Observe | None = None) -> None:
    """Write-once snapshot; fails if the folder exists."""
    with shuffles_removed(df.sparkSession):
        _balanced(df, (), observe).write.mode("errorifexists").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """W4o: replace the folder's content."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
