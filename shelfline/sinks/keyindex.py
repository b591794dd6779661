"""A kept index of the keys ingested so far (A1, L2 across days): an increment is checked
against all history by reading keys only, and of the keys only those in its range."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Neighbouring keys that share a folder of the index.
RANGE_KEYS = 1 << 24


class KeyIndex:
    """Whole-number keys below ``path`` with the day on which each was first ingested,
    in folders by key range.  One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, key: str, range_keys: int = RANGE_KEYS):
        self.spark, self.path, self.key, self.range_keys = spark, path, key, range_keys

    def _range(self, key: Column | str) -> Column:
        key = F.col(key) if isinstance(key, str) else key
        return F.floor(key / F.lit(self.range_keys)).cast("long")

    def known(self, rows: DataFrame) -> DataFrame:
        """key, date of the index in the key range of ``rows``: other folders are pruned,
        and the bounds reach the row groups of the files, which are sorted by key."""
        empty = self.spark.createDataFrame([], f"`{self.key}` long, date date")
        low, high = rows.agg(F.min(self.key), F.max(self.key)).first()
        if low is None:
            return empty
        try:
            index = self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return empty
            raise
        ranges = F.col("key_range").between(low // self.range_keys, high // self.range_keys)
        return index.where(ranges & F.col(self.key).between(low, high)).select(self.key, "date")

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows (with ``date``) whose key was not ingested on another day.  Rows
        of the key's own day stay, so a day can be run again; rows without key stay."""
        known = self.known(rows).select(F.col(self.key).alias("_known"), F.col("date").alias("_first"))
        return rows.join(known, (F.col(self.key) == F.col("_known")) & (F.col("date") != F.col("_first")), "left_anti")

    def add(self, rows: DataFrame) -> None:
        """Adds the keys of ``rows`` that the index lacks, with their first day.  A rerun
        adds nothing."""
        keys = rows.where(F.col(self.key).isNotNull()).groupBy(F.col(self.key).cast("long").alias(self.key)).agg(
            F.min("date").alias("date"))
        new = keys.join(self.known(rows).select(self.key), self.key, "left_anti").withColumn("key_range", self._range(self.key))
        (new.hint("rebalance", "key_range").sortWithinPartitions("key_range", self.key)
         .write.mode("append").partitionBy("key_range").parquet(self.path))
