"""Sinks: partitioned Parquet writes (W1-W4) and snapshot tables."""
from .parquet import write_partitioned, replace_partitions, write_once, overwrite
from .tables import SnapshotTable

__all__ = ["write_partitioned", "replace_partitions", "write_once", "overwrite", "SnapshotTable"]
