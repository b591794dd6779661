"""As-of join of dated rows with versioned reference snapshots (R4v with J3, J7): each
row sees the newest snapshot up to its own month, not one version for all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """All snapshots below ``root``, with their ``version`` as text."""
    df = spark.read.parquet(root)
    return df.withColumn("version", F.col("version").cast("string"))


def version_by_month(months: DataFrame, versions: DataFrame) -> DataFrame:
    """month, version: for every month of ``months`` the newest version up to it; months
    before the first version are left out.  Both are lists of calendar months, so the
    ordered pass over them sees a few hundred rows."""
    marks = months.select("month", F.lit(None).cast("string").alias("version")).distinct().unionByName(
        versions.select(F.col("version").alias("month"), "version").distinct())
    upto = Window.orderBy("month").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (marks.withColumn("own", F.col("version").isNull())
            .withColumn("version", F.max("version").over(upto))
            .where("own AND version IS NOT NULL").select("month", "version"))


def join_as_of(df: DataFrame, versions: DataFrame, key: str, date: str = "date") -> DataFrame:
    """``df`` with the columns of ``versions`` (key, version, attributes) of the snapshot
    that holds in the row's month, and ``version``; nulls where there is no snapshot
    yet, no date, or no such key in that snapshot.  Versions are yyyy-MM.

    The version is looked up per month (a broadcast of one row per calendar month); the
    join itself is then an equi-join on (version, key), so a hot month or version is
    spread by the key.  A snapshot with several rows for a key repeats the row, as a
    plain join does."""
    month = F.date_format(F.col(date), "yyyy-MM")
    valid = version_by_month(df.where(F.col(date).isNotNull()).select(month.alias("month")).distinct(), versions)
    lookup = F.broadcast(valid.select(F.col("month").alias("_month"), F.col("version").alias("_version")))
    attributes = [c for c in versions.columns if c not in (key, "version")]
    snapshot = versions.select(F.col(key).alias("_key"), F.col("version").alias("_held"), *attributes)
    dated = df.join(lookup, month == F.col("_month"), "left")
    return (dated.join(snapshot, (F.col(key) == F.col("_key")) & (F.col("_version") == F.col("_held")), "left")
            .select(*df.columns, *attributes, F.col("_version").alias("version")))
