"""Helpers shared by the corpus operators: byte-level words, Arrow batches,
intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from shelfline.session import stored

__all__ = ["blank_words", "broadcast_object", "chunks", "runs", "stored", "task_count", "unused", "utf8", "words"]


def _word_table() -> bytes:
    out = bytearray(range(256)).lower()
    for b in [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]:
        out[b] = 0x20
    return bytes(out)


#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
WORD_TABLE = _word_table()


def words(text: bytes) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the text with A-Z lower-cased."""
    return text.translate(WORD_TABLE).split()


def blank_words(text: bytes) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]`` of the text with A-Z lower-cased."""
    return text.lower().split()


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null becomes empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], max_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``max_bytes`` together, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > max_bytes:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def broadcast_object(spark: SparkSession, value: object) -> Callable[[], object]:
    """A broadcast object, to be called for in tasks.  It travels by value, like
    the functions of this package, and a Python worker keeps one copy between
    tasks.  For objects of bounded size only."""
    held = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    def get() -> object:
        own = held.value
        if "object" not in own:
            own["object"] = cloudpickle.loads(own.pop("pickled"))
        return own["object"]

    return get


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it no column of ``df``."""
    out = []
    for name in names:
        while name.lower() in map(str.lower, df.columns):
            name = "_" + name
        out.append(name)
    return out


def task_count(spark: SparkSession) -> int:
    """Partitions for shuffles whose rows are consumed in order by Python tasks."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
