"""Physical-plan properties the jobs rely on at scale."""

import datetime as dt

from pyspark.sql import functions as F

from shelfline import operators as op
from shelfline.functions.dates import month_range
from shelfline.session import fresh_path
from shelfline.sinks import parquet
from shelfline.sources.files import read_parquet, read_partition


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _fact_table(spark):
    days = [dt.date(2025, 9, 30), dt.date(2025, 10, 1), dt.date(2025, 10, 20), dt.date(2025, 11, 2)]
    rows = [(i, i % 3, 20251000 + i, "Card", 1, 2.0, 2.0, 0.4, d) for i, d in enumerate(days)]
    fact = spark.createDataFrame(rows, "sale_id long, store_id int, date_id int, payment_method string, "
                                       "quantity int, unit_price double, line_amount double, VAT double, date date")
    p = fresh_path(spark, "plan-fact")
    parquet.write_partitioned(fact, p, "date")
    return p


def test_month_filter_prunes_partitions(spark):
    p = _fact_table(spark)
    lo, hi = month_range("2025-10")
    df = read_parquet(spark, p).where((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(date" in plan and "2025-10-01" in plan
    assert df.count() == 2


def test_day_read_lists_one_folder(spark):
    p = _fact_table(spark)
    df = read_partition(spark, p, "2025-10-20")
    files = df.inputFiles()
    assert files and all("/date=2025-10-20/" in f for f in files)
    assert df.select("date").distinct().collect()[0][0] == dt.date(2025, 10, 20)


def test_aggregate_scan_reads_only_needed_columns(spark):
    p = _fact_table(spark)
    fact = read_parquet(spark, p)
    plan = _plan(op.create_monthly_customer_metrics(fact))
    schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "sale_id" in schema and "line_amount" in schema
    assert "payment_method" not in schema and "unit_price" not in schema


def test_dim_date_is_broadcast_in_fact_join(spark):
    sales = spark.createDataFrame([(1, 1, dt.datetime(2025, 10, 20, 9), 1.0)],
                                  "sale_id long, store_id int, timestamp timestamp_ntz, total_amount double")
    details = spark.createDataFrame([("a", 1, 7, 1, 2.0, 0.4)],
                                    "detail_id string, sale_id long, product_id long, quantity int, "
                                    "unit_price double, VAT double")
    payments = spark.createDataFrame([(1, 1, "Card", 1.0)], "payment_id long, sale_id long, method string, amount double")
    fact = op.create_fact_sales(sales, details, payments, op.create_dim_date(sales))
    plan = fact._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "_dd_date" in plan


def _scans(df, column) -> int:
    """Scans in the static plan that read ``column``."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return sum("FileScan" in line and column in line for line in plan.splitlines())


def test_skewed_joins_evaluate_their_inputs_once(spark):
    from shelfline.plans.catalog import QUERIES
    from tests.conftest import SF001
    assert _scans(QUERIES["clean_sales_details"](spark, SF001), "l_orderkey") <= 2
    assert _scans(QUERIES["store_performance"](spark, SF001), "l_orderkey") <= 6


def test_store_performance_needs_no_expand(spark):
    from shelfline.plans.catalog import QUERIES
    from tests.conftest import SF001
    for name in ("store_performance", "store_performance_avg_daily"):
        assert "Expand" not in QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()


def test_each_table_is_deduplicated_once_per_job(spark, tmp_lake, monkeypatch):
    from shelfline.plans import jobs
    from shelfline.plans.catalog import _sources
    from tests.conftest import SF001
    jobs.ingest_full(spark, tmp_lake, _sources(SF001), version="2025-07")
    seen = []
    dedup = jobs.op.dedup_by_key
    monkeypatch.setattr(jobs.op, "dedup_by_key", lambda df, key: seen.append(key) or dedup(df, key))
    raw = jobs._deduplicated(spark, tmp_lake, jobs.RAW_TX)
    assert sorted(seen) == ["detail_id", "payment_id", "sale_id"]
    for df in raw.values():  # what the job's steps read is a written table
        assert "Aggregate" not in df._jdf.queryExecution().sparkPlan().toString()
