"""JDBC sources.

The whole-table read of the original is single-partition; here a numeric
column and bounds split it into ``num_partitions`` parallel range reads, and
row filters are written as DataFrame predicates so Spark pushes them into the
database's WHERE clause (no hand-written SQL text is needed for an increment).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import in_window


@dataclass(frozen=True)
class JdbcSource:
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    fetchsize: int = 10_000
    # table -> (partition column, lower bound, upper bound, partitions)
    partitioning: dict[str, tuple[str, int, int, int]] = field(default_factory=dict)
    # tables (and queries) that may be read by one task, because they are known to be small
    single_partition: frozenset[str] = frozenset()

    def options(self, table: str) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": table, "fetchsize": str(self.fetchsize), **self.properties}
        if table in self.partitioning:
            c, lo, hi, n = self.partitioning[table]
            opts.update(partitionColumn=c, lowerBound=str(lo), upperBound=str(hi), numPartitions=str(n))
        return opts

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """Whole table (R2) in parallel range reads.  A table without
        partitioning must be named in ``single_partition``."""
        if table not in self.partitioning and table not in self.single_partition:
            raise ValueError(f"give partitioning for {table}, or name it in single_partition")
        return spark.read.format("jdbc").options(**self.options(table)).load()

    def read_query(self, spark: SparkSession, query: str) -> DataFrame:
        """A query run by the database (R3).  With ``partitioning`` for the query
        text it is read as a derived table in parallel ranges; otherwise it must
        be named in ``single_partition``."""
        if query in self.partitioning:
            opts = self.options(query) | {"dbtable": f"({query}) q"}
        elif query in self.single_partition:
            opts = {"url": self.url, "query": query, "fetchsize": str(self.fetchsize), **self.properties}
        else:
            raise ValueError("give partitioning for the query, or name it in single_partition")
        return spark.read.format("jdbc").options(**opts).load()

    def read_increment(self, spark: SparkSession, table: str, column: str, lo, hi) -> DataFrame:
        """Rows with lo <= column < hi; the predicate is pushed to the database."""
        df = self.read(spark, table)
        return df.where(in_window(df, column, lo, hi))

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        return self.read(spark, table)
