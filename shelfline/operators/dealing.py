"""Rows dealt by columns, for a write partitioned by them.

A rebalance shuffles whole rows, and text and doubles take most of their bytes there.
Where the rows are many, each task puts the rows of a group of values together as an
Arrow batch, compressed, and the batches are rebalanced instead: the same rows lie together
afterwards, in a part of the bytes.  Adaptive execution joins and splits partitions as before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows from which they are shuffled as compressed batches.
PACKED_FROM = 2_000_000
#: Groups of values that the rows are dealt to, and rows and bytes of a task that are put together.
GROUPS = 256
HELD_ROWS, HELD_BYTES = 1 << 20, 128 << 20

_GROUP, _SIZE, _ROWS = "_dealt_to", "_dealt_size", "_dealt_rows"
_PLAIN = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
          T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def balanced(df: DataFrame, cols: Sequence[str], rows: int | None = None) -> DataFrame:
    """``df`` rebalanced on ``cols``; as compressed batches where it is said to have more than
    ``PACKED_FROM`` ``rows`` and all its columns are of plain types."""
    if not cols:
        return df
    if rows is None or rows <= PACKED_FROM or not all(isinstance(f.dataType, _PLAIN) or f.dataType == T.StringType() for f in df.schema):
        return df.hint("rebalance", *cols)
    group = F.pmod(F.xxhash64(*cols), F.lit(GROUPS)).cast("int")
    packed = df.withColumn(_GROUP, group).mapInArrow(_packed, f"{_GROUP} int, {_SIZE} long, {_ROWS} binary")
    return packed.hint("rebalance", _GROUP).mapInArrow(_unpacked, df.schema)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per group and as many rows as are held: the group's rows as a compressed stream."""
    codec = pa.Codec("zstd", compression_level=3)

    def groups(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        of = rows.column(_GROUP).to_numpy()
        order = np.argsort(of, kind="stable")
        rows = rows.drop_columns([_GROUP]).take(pa.array(order)).combine_chunks()
        found, first = np.unique(of[order], return_index=True)
        sizes, blobs = [], []
        for start, end in zip(first, np.append(first[1:], len(order)), strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_table(rows.slice(start, end - start))
            stream = sink.getvalue()
            sizes.append(stream.size)
            blobs.append(codec.compress(stream, asbytes=True))
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                                          [_GROUP, _SIZE, _ROWS])

    held, n, size = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
        if n >= HELD_ROWS or size >= HELD_BYTES:
            yield groups(held)
            held, n, size = [], 0, 0
    if held:
        yield groups(held)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    held, n = [], 0
    for batch in batches:
        for size, blob in zip(batch.column(_SIZE).to_pylist(), batch.column(_ROWS), strict=True):
            rows = pa.ipc.open_stream(codec.decompress(blob.as_buffer(), size)).read_all()
            held.append(rows)
            n += rows.num_rows
            if n >= 10_000:
                yield from pa.concat_tables(held).combine_chunks().to_batches(max_chunksize=20_000)
                held, n = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()
