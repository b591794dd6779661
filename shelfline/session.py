"""Session helpers: a configured local session for tests/bench and the shared
scratch folder used to cut lineage and to publish intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCALE_CONFIGS = {
    # Adaptive execution: coalesce small shuffle partitions, split skewed
    # join partitions, turn sort-merge joins into broadcast joins when a side
    # is measured small at runtime.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "shelfline", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, bench and local runs.  On a cluster the caller passes
    its own session instead; nothing in the library depends on these values."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONFIGS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job outputs.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only a local-mode session without one gets a fresh temp folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            d = tempfile.mkdtemp(prefix="shelfline-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the scratch folder."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files go when the write that made them ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of writes made here are removed when their write ends: what was
    written is read from there, so they are of no use to later steps."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet below the shared scratch folder and read back:
    lineage ends there and later readers do not repeat the work."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
