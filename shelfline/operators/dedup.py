"""Deterministic key dedup of a replayed feed (A1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored


def dedup_by_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row per key: the smallest row in column order (nulls first).

    Written as ``groupBy(key).agg(min(struct(other columns)))`` instead of a
    ``row_number`` window: the aggregate runs map-side before the shuffle, so a
    key replayed millions of times leaves each map task as one row.  (A struct
    minimum is a sort aggregate: every map task sorts its own rows by key.)  Same result as
    ``row_number() over (partition by key order by all columns) = 1``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    best = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    return best.select(*[F.col(k) if k in keys else F.col("_row")[k].alias(k) for k in df.columns])


#: Keys beyond which all rows are deduplicated instead of those of repeated keys.
MAX_REPEATED = 1_000_000


#: Hashes have 42 bits: a group, and a number of 32 bits that a shuffle carries in 4 bytes.
HASH_BITS = 42
#: Rows of a task whose hashes are put together before they are shuffled.
HASHES = 1 << 20


def _key_hash(key: str) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _grouped_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes as a list of numbers per group; one that comes more often comes twice."""
    def lists(held: list[np.ndarray]) -> pa.RecordBatch:
        hashes, n = np.unique(np.concatenate(held), return_counts=True)
        hashes = np.repeat(hashes, np.minimum(n, 2))
        groups, first = np.unique(hashes >> 32, return_index=True)
        numbers = (hashes & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
        offsets = np.append(first, len(hashes)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(groups.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers))],
                                          ["_group", "_numbers"])

    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch.column(0).to_numpy())
        if sum(map(len, held)) >= HASHES:
            yield lists(held)
            held = []
    if held:
        yield lists(held)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """``_hash`` of the keys that more than one row has, counted now and kept in the
    scratch folder.  Only hashes are shuffled; keys that share a hash count as repeated."""
    hashes = df.select(_key_hash(key).alias("_hash")).mapInArrow(_grouped_hashes, "_group int, _numbers array<int>")
    counts = (hashes.repartition("_group").select("_group", F.explode("_numbers").alias("_number"))
              .groupBy("_group", "_number").agg(F.count(F.lit(1)).alias("_n")))
    number = F.col("_number").cast("long").bitwiseAND(F.lit((1 << 32) - 1))
    return stored(counts.where(F.col("_n") > 1).select(
        F.shiftleft(F.col("_group").cast("long"), 32).bitwiseOR(number).alias("_hash")), "repeated-keys")


def split_repeated(df: DataFrame, key: str, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of keys that come once, and the others; neither shuffles ``df``."""
    hashed = df.withColumn("_hash", _key_hash(key))
    few = F.broadcast(repeated)
    once, again = (hashed.join(few, "_hash", how).select(df.columns) for how in ("left_anti", "left_semi"))
    return once, again
