"""Tables stored in buckets of a key (J1, J2, J4, J5, J6, J8 on stored layout).

Joins and group-bys on the key of tables with equal buckets read matching buckets
together and need no shuffle.  The files lie in a folder of the lake; the session's
catalog only holds the definition, so another session opens the folder anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Buckets of a table where the caller names none.
BUCKETS = 64


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Writes ``df`` below ``path`` in ``buckets`` buckets of ``key``, sorted inside.

    The rows are rebalanced on the key first: a bucket is then a few files, and a
    key with a large share of all rows is dealt to several tasks, each of which
    writes a file of the bucket."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.hint("rebalance", buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).mode("overwrite").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The table below ``path``, known to be in ``buckets`` buckets of ``key``."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
