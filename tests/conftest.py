import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfline.session import build_session
    scratch = tempfile.mkdtemp(prefix="shelfline-tests-")
    s = build_session(app="shelfline-tests", master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": f"{scratch}/checkpoints",
                             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
                             "spark.sql.sources.parallelPartitionDiscovery.parallelism": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_lake(spark):
    from shelfline.session import fresh_path
    from shelfline.sources.layout import Lake
    return Lake(fresh_path(spark, "test-lake"))


def rows(df, *cols):
    """Sorted list of tuples (of the given columns, default all)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))
