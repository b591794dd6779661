"""Benchmark: wall time of the headline queries and the full jobs.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfline.plans import jobs  # noqa: E402
from shelfline.plans.catalog import QUERIES, REF_VERSION, _sources  # noqa: E402
from shelfline.session import build_session, fresh_path  # noqa: E402
from shelfline.sources.layout import Lake  # noqa: E402

HEADLINE = ["store_performance", "daily_store_sales", "daily_product_sales",
            "monthly_customer_metrics", "product_sales_trends"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="shelfline-bench-")
    spark = build_session(app="shelfline-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "8g",
                                 "spark.checkpoint.dir": f"{scratch}/checkpoints",
                                 "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
                                 "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(cpus)})
    times: dict[str, float] = {}

    def timed(name, fn):
        if only and name not in only:
            return
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # warm-up: JVM start, first scan of the tables
    QUERIES["dim_store"](spark, sf_dir).count()
    for q in HEADLINE:
        timed(q, lambda q=q: QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save())

    lake = Lake(fresh_path(spark, "bench-lake"))
    src = _sources(sf_dir)
    timed("ingest_full", lambda: jobs.ingest_full(spark, lake, src, version=REF_VERSION))
    timed("transform_full", lambda: jobs.transform_full(spark, lake))
    timed("model_full", lambda: jobs.model_full(spark, lake))
    timed("aggregate_full", lambda: jobs.aggregate_full(spark, lake))
    timed("model_daily", lambda: jobs.model_daily(spark, lake, day="1998-03-16").collect())
    timed("aggregate_monthly", lambda: jobs.aggregate_monthly(spark, lake, month="1998-03"))
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
