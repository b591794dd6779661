"""Run one job of the lake: ``python -m shelfline STAGE MODE --lake ROOT [...]``.

The session is the one Spark is started with (``spark-submit``), so cluster
settings, ``spark.checkpoint.dir`` among them, come from there.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from shelfline.plans import jobs
from shelfline.sources.factory import make_sources, parquet_transactions
from shelfline.sources.jdbc import JdbcSource
from shelfline.sources.layout import Lake


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shelfline", description=__doc__.splitlines()[0])
    p.add_argument("stage", help="ingestion, transformation, modeling or aggregation")
    p.add_argument("mode", help="full, daily or monthly")
    p.add_argument("--lake", required=True, help="root folder of the lake")
    p.add_argument("--format", default="parquet", help="format of the curated and serving tables")
    p.add_argument("--day", help="date of a daily run (yyyy-mm-dd)")
    p.add_argument("--month", help="month of a monthly aggregation (yyyy-mm)")
    p.add_argument("--version", help="reference snapshot to write or read")
    p.add_argument("--as-of", help="read the latest reference snapshot up to this one")
    p.add_argument("--products", help="CSV file of products")
    p.add_argument("--stores", help="CSV file of stores")
    p.add_argument("--transactions", help="folder of Parquet tables")
    p.add_argument("--jdbc", help="JSON file with url, properties, partitioning and single_partition of the database")
    return p


def _transactions(a: argparse.Namespace):
    if a.jdbc:
        with open(a.jdbc, encoding="utf-8") as f:
            spec = json.load(f)
        return JdbcSource(spec["url"], spec.get("properties", {}),
                          partitioning={t: tuple(v) for t, v in spec.get("partitioning", {}).items()},
                          single_partition=frozenset(spec.get("single_partition", ())))
    if a.transactions:
        return parquet_transactions(a.transactions)

    def none(spark, table):
        raise ValueError("give --jdbc or --transactions")
    return none


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"shelfline {a.stage} {a.mode}").getOrCreate()
    params = {"day": a.day, "month": a.month, "version": a.version, "as_of": a.as_of}
    params = {k: v for k, v in params.items() if v is not None}
    if a.stage.strip().lower() == "ingestion":
        params["src"] = make_sources(_transactions(a), a.products, a.stores)
    out = jobs.run(a.stage, a.mode, spark, Lake(a.lake, a.format), **params)
    if out is not None:
        out.show(truncate=False)


if __name__ == "__main__":
    main()
