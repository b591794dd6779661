"""Equi-joins that split hot keys.

Adaptive execution splits a skewed join only when both inputs are shuffle
stages; a join whose other side comes straight out of an aggregate or of
another join on the same key is not split.  ``join_split_hot`` salts the keys
with more left rows than one task should take.  Each input is evaluated once:
the hot keys are counted on the bare key column of the table the left rows come
from, not on the joined left input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Left rows of one key that one task joins before the key is split.
ROWS_PER_TASK = 2_000_000
# Left rows that a task of a large join takes.
ROWS_PER_PART = 500_000
# Rows of a reference table that a join may broadcast (some 300 MB of products).
MAX_BROADCAST = 2_000_000
# Salts of left rows whose key is null: they match nothing, so they only need spreading.
NULL_SALTS = 1024


def hot_keys(keys: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of splits each
    needs.  There are at most rows / rows_per_task of them (about 500,000
    two-number rows for a trillion rows): a proven bound, safe to broadcast.
    Counted now, with map-side partial aggregation over one column, and kept in
    the scratch folder, because both sides of a join read it."""
    return stored(keys.select(key).where(F.col(key).isNotNull())
                  .groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_task)
                  .select(key, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts")), "hot-keys")


def join_parts(rows: DataFrame) -> int | None:
    """Partitions of a join whose left side has about as many rows as the table ``rows``,
    so that what a task sorts and groups does not grow with the table.  None (the
    session's setting) while that makes fewer tasks than the session runs at a time."""
    parts = -(-rows.count() // ROWS_PER_PART)
    return parts if parts > rows.sparkSession.sparkContext.defaultParallelism else None


def broadcast_if_few(reference: DataFrame) -> tuple[DataFrame, bool]:
    """``reference``, to be broadcast where it is counted to hold at most ``MAX_BROADCAST``
    rows, and whether it is: rows that are joined to it then stay where they are."""
    few = reference.count() <= MAX_BROADCAST
    return (F.broadcast(reference) if few else reference), few


def day_parts(rows: DataFrame, column: str = "date") -> DataFrame:
    """``_day`` and ``_parts``: the parts of ``ROWS_PER_PART`` rows that each calendar day
    of ``rows`` makes (safe to broadcast).  Counted now, kept in the scratch folder."""
    return stored(rows.groupBy(F.col(column).alias("_day")).agg(
        F.ceil(F.count(F.lit(1)) / ROWS_PER_PART).cast("int").alias("_parts")), "day-parts")


def with_part(df: DataFrame, days: DataFrame, column: str, key: str) -> DataFrame:
    """Adds ``_part``: the place of ``key`` among the parts of its day.  Days and parts
    tell where a row is shuffled to, so that grouped rows can be written by day as they lie."""
    part: Column = F.pmod(F.xxhash64(key), F.coalesce("_parts", F.lit(1))).cast("int")
    return (df.join(F.broadcast(days), F.col(column) == F.col("_day"), "left")
            .select(*df.columns, part.alias("_part")))


def shuffled(df: DataFrame, parts: int | None, *columns: str) -> DataFrame:
    """``df`` dealt by ``columns`` to ``parts`` partitions (None: the session's number)."""
    return df.repartition(parts, *columns) if parts else df.repartition(*columns)


def join_split_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner", *,
                   hot: DataFrame, salt_by: str, parts: int | None = None) -> DataFrame:
    """``left.join(right, key, how)`` (how: inner or left) with the ``hot`` keys
    of the left side split.  Left rows of a hot key are spread over its salts by
    a hash of ``salt_by`` (a column that tells its rows apart; stable across
    retries), and the key's right rows are repeated once per salt.  Left rows
    with a null key are spread too.  ``parts``: see :func:`join_parts`.  Same rows as
    the plain join."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    hot = F.broadcast(hot)
    salts = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(hot, key, "left").select(
        *left.columns, F.pmod(F.xxhash64(salt_by), salts).cast("int").alias("_salt"))
    salted_right = right.join(hot, key, "left").select(
        *right.columns, F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt"))
    if parts:
        salted_left, salted_right = (df.repartition(parts, key, "_salt") for df in (salted_left, salted_right))
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
