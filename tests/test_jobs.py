import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.config import CLEANED_TX, CURATED, RAW_TX, SERVING
from shelfline.plans import jobs
from shelfline.schemas import PAYMENTS, SALES, SALES_DETAILS
from shelfline.sources.files import read_parquet
from tests.conftest import rows

T = [dt.datetime(2025, 9, 30, 10), dt.datetime(2025, 10, 20, 9), dt.datetime(2025, 10, 20, 17),
     dt.datetime(2025, 10, 21, 8)]


@pytest.fixture()
def sources(spark):
    sales = spark.createDataFrame([(1, 1, T[0], 30.0), (2, 1, T[1], 0.0), (3, 2, T[2], 12.0), (4, 3, T[3], 8.0)],
                                  SALES)
    details = spark.createDataFrame([("a", 1, 7, 1, 30.0), ("b", 2, 7, 2, 10.0), ("c", 3, 8, 1, 12.0),
                                     ("d", 4, 8, 1, 8.0), ("e", 4, 7, 0, 9.0)], SALES_DETAILS)
    payments = spark.createDataFrame([(10, 1, "Card", 30.0), (11, 2, "Unknown", 24.0), (12, 3, "Cash", 12.0),
                                      (13, 4, "Cash", 8.0)], PAYMENTS)
    products = spark.createDataFrame([(7, "Jacket", "Denim Jacket", "Clothing", 5.0),
                                      (8, "Sandals", "Canvas Sandals", "Footwear", 9.0)],
                                     "product_id long, name string, description string, category string, unit_price double")
    stores = spark.createDataFrame([(1, "S1", "A1", "Tunis", 11), (2, "S2", "A2", "Sfax", 16)],
                                   "store_id int, name string, address string, town string, number_of_employees int")
    tx = {"sales": sales, "sales_details": details, "payments": payments}
    return jobs.Sources(transactions=lambda spark, t: tx[t], products=lambda spark: products,
                        stores=lambda spark: stores)


def _full(spark, lake, sources):
    jobs.run("Ingestion", "FULL", spark, lake, src=sources, version="2025-10")
    jobs.run("transformation", "full", spark, lake, median_method="exact")
    jobs.run("modeling", "full", spark, lake)
    jobs.run("aggregation", "full", spark, lake)


def test_full_chain(spark, tmp_lake, sources):
    _full(spark, tmp_lake, sources)
    raw = read_parquet(spark, tmp_lake.table(RAW_TX, "sales_details"))
    assert raw.count() == 5 and "date" in raw.columns
    cleaned = read_parquet(spark, tmp_lake.table(CLEANED_TX, "sales"))
    assert {r.sale_id: r.total_amount for r in cleaned.collect()}[2] == 24.0   # 2 x 10 + VAT 4
    pays = read_parquet(spark, tmp_lake.table(CLEANED_TX, "payments"))
    assert sorted(r.method for r in pays.collect()) == ["Card", "Card", "Cash", "Cash"]
    fact = jobs.table(spark, tmp_lake, CURATED, "fact_sales").read()
    assert fact.count() == 4
    sp = jobs.table(spark, tmp_lake, SERVING, "store_performance").read()
    assert rows(sp, "store_id", "month_year", "monthly_revenue") == [(1, "2025-09", 30.0), (1, "2025-10", 20.0),
                                                                     (2, "2025-10", 12.0), (3, "2025-10", 8.0)]


def test_daily_reruns_are_idempotent(spark, tmp_lake, sources):
    _full(spark, tmp_lake, sources)
    fact_t = jobs.table(spark, tmp_lake, CURATED, "fact_sales")
    before = rows(fact_t.read())
    dss_t = jobs.table(spark, tmp_lake, SERVING, "daily_store_sales")
    dss = rows(dss_t.read())
    for _ in range(2):
        jobs.ingest_daily(spark, tmp_lake, sources, day="2025-10-20")
        jobs.transform_daily(spark, tmp_lake, day="2025-10-20", cap=1000.0)
        audit = jobs.model_daily(spark, tmp_lake, day="2025-10-20").collect()[0]
        jobs.aggregate_daily(spark, tmp_lake, day="2025-10-20")
    assert audit.row_count == 2 and audit.distinct_dates == 1
    assert rows(fact_t.read()) == before
    assert rows(dss_t.read()) == dss
    assert read_parquet(spark, tmp_lake.table(RAW_TX, "sales")).count() == 4


def test_monthly_replaces_only_its_month(spark, tmp_lake, sources):
    _full(spark, tmp_lake, sources)
    t = jobs.table(spark, tmp_lake, SERVING, "store_performance")
    before = rows(t.read().where("month_year = '2025-09'"))
    jobs.run("aggregation", "monthly", spark, tmp_lake, month="2025-10")
    assert rows(t.read().where("month_year = '2025-09'")) == before
    assert t.read().where("month_year = '2025-10'").count() == 3


def test_reference_ingest_is_write_once(spark, tmp_lake, sources):
    audit = jobs.ingest_reference(spark, tmp_lake, sources, version="2025-11")
    assert rows(audit) == [("products", 2), ("stores", 2)]
    with pytest.raises(Exception):
        jobs.ingest_reference(spark, tmp_lake, sources, version="2025-11")


def test_dispatch_rejects_unknown_modes(spark, tmp_lake):
    with pytest.raises(ValueError):
        jobs.run("aggregation", "weekly", spark, tmp_lake)
    with pytest.raises(ValueError):
        jobs.run("reporting", "full", spark, tmp_lake)


def test_daily_append_mode_duplicates_are_removed_downstream(spark, tmp_lake, sources):
    jobs.ingest_full(spark, tmp_lake, sources, version="2025-10")
    jobs.ingest_daily(spark, tmp_lake, sources, day="2025-10-20", mode="append")
    raw = read_parquet(spark, tmp_lake.table(RAW_TX, "sales"))
    assert raw.count() == 6
    jobs.transform_full(spark, tmp_lake, median_method="exact")
    assert read_parquet(spark, tmp_lake.table(CLEANED_TX, "sales")).count() == 4
    assert read_parquet(spark, tmp_lake.table(CLEANED_TX, "sales")).where(F.col("sale_id") == 2).count() == 1


def _replayed(spark, lake, sources):
    """A lake in which two sales, with lines and payments, came again on a later day; one line came twice."""
    jobs.ingest_full(spark, lake, sources, version="2025-10")
    later = F.col("timestamp") + F.expr("INTERVAL 2 DAYS")
    again = {t: sources.transactions(spark, t).where("sale_id IN (2, 3)") for t in jobs.TX_KEYS}
    again["sales"] = again["sales"].withColumn("timestamp", F.when(F.col("sale_id") == 2, later).otherwise(F.col("timestamp")))
    again["sales"] = again["sales"].withColumn("total_amount", F.col("total_amount") - 1)
    replay = jobs.Sources(lambda spark, t: again[t], sources.products, sources.stores)
    for day in ("2025-10-20", "2025-10-22"):
        jobs.ingest_daily(spark, lake, replay, day=day, mode="append")


def test_only_rows_of_repeated_keys_are_deduplicated(spark, tmp_lake, sources):
    _replayed(spark, tmp_lake, sources)
    found = jobs._deduplicated(spark, tmp_lake, RAW_TX)
    for t, key in jobs.TX_KEYS.items():
        raw = read_parquet(spark, tmp_lake.table(RAW_TX, t))
        assert raw.count() > found[t].count()
        assert found[t].dtypes == raw.dtypes and rows(found[t]) == rows(jobs.op.dedup_by_key(raw, key))
        assert set(raw.inputFiles()) & set(found[t].inputFiles())  # other rows are read where they are
        assert "Exchange hash" not in found[t]._jdf.queryExecution().executedPlan().toString()


def test_few_and_many_repeated_keys_give_the_same_rows(spark, tmp_lake, sources, monkeypatch):
    """Rows of sales that moved to another day get the date of their sale, by either way."""
    _replayed(spark, tmp_lake, sources)
    jobs.transform_full(spark, tmp_lake, median_method="exact")
    few = {t: rows(read_parquet(spark, tmp_lake.table(CLEANED_TX, t))) for t in jobs.TX_KEYS}
    monkeypatch.setattr(jobs.dedup, "MAX_REPEATED", 0)
    jobs.transform_full(spark, tmp_lake, median_method="exact")
    assert few == {t: rows(read_parquet(spark, tmp_lake.table(CLEANED_TX, t))) for t in jobs.TX_KEYS}
    day = {r.sale_id: r.date for r in read_parquet(spark, tmp_lake.table(CLEANED_TX, "sales")).collect()}
    for t in ("sales_details", "payments"):
        cleaned = read_parquet(spark, tmp_lake.table(CLEANED_TX, t)).collect()
        assert cleaned and all(r.date == day[r.sale_id] for r in cleaned)


def _files(spark, lake, table):
    return {f.rsplit("/date=", 1)[1] for f in read_parquet(spark, lake.table(RAW_TX, table)).inputFiles()}


def test_daily_ingest_touches_only_its_day(spark, tmp_lake, sources):
    """On a lake with history, and with a source that lost the old lines."""
    jobs.ingest_full(spark, tmp_lake, sources, version="2025-10")
    before = {t: _files(spark, tmp_lake, t) for t in jobs.TX_KEYS}
    recent = jobs.Sources(
        lambda spark, t: sources.transactions(spark, t).where("sale_id >= 4") if t != "sales" else sources.transactions(spark, t),
        sources.products, sources.stores)
    jobs.ingest_daily(spark, tmp_lake, recent, day="2025-10-21")
    for t in jobs.TX_KEYS:
        after = _files(spark, tmp_lake, t)
        assert {f for f in after if not f.startswith("2025-10-21")} == {f for f in before[t] if not f.startswith("2025-10-21")}
    assert read_parquet(spark, tmp_lake.table(RAW_TX, "sales_details")).count() == 5
    jobs.ingest_daily(spark, tmp_lake, sources, day="2025-10-21", mode="append")
    details = read_parquet(spark, tmp_lake.table(RAW_TX, "sales_details"))
    assert rows(details.groupBy("date").count()) == [(dt.date(2025, 9, 30), 1), (dt.date(2025, 10, 20), 2), (dt.date(2025, 10, 21), 4)]


def test_a_day_that_lost_its_payments_is_cleared_everywhere(spark, tmp_lake, sources):
    _full(spark, tmp_lake, sources)
    day = "2025-10-21"
    unpaid = jobs.Sources(
        lambda spark, t: sources.transactions(spark, t).where("sale_id <> 4") if t == "payments" else sources.transactions(spark, t),
        sources.products, sources.stores)
    jobs.ingest_daily(spark, tmp_lake, unpaid, day=day)
    jobs.transform_daily(spark, tmp_lake, day=day, cap=1000.0)
    jobs.model_daily(spark, tmp_lake, day=day)
    jobs.aggregate_daily(spark, tmp_lake, day=day)
    on_day = F.col("date") == F.lit(dt.date(2025, 10, 21))
    assert read_parquet(spark, tmp_lake.table(RAW_TX, "payments")).where(on_day).count() == 0
    assert read_parquet(spark, tmp_lake.table(CLEANED_TX, "payments")).where(on_day).count() == 0
    assert read_parquet(spark, tmp_lake.table(CLEANED_TX, "sales_details")).where(on_day).count() == 1
    assert jobs.table(spark, tmp_lake, CURATED, "fact_sales").read().where(on_day).count() == 0
    for t in jobs.DAILY_AGGS:
        assert jobs.table(spark, tmp_lake, SERVING, t).read().where(on_day).count() == 0
        assert jobs.table(spark, tmp_lake, SERVING, t).read().count() > 0


def test_reference_version_as_of_the_run(spark, tmp_lake, sources):
    jobs.ingest_full(spark, tmp_lake, sources, version="2025-09")
    later = jobs.Sources(sources.transactions, lambda spark: sources.products(spark).withColumn("category", F.lit("new")), sources.stores)
    jobs.ingest_reference(spark, tmp_lake, later, version="2025-11")
    jobs.transform_daily(spark, tmp_lake, day="2025-10-20", as_of="2025-10", cap=1000.0)
    cleaned = read_parquet(spark, tmp_lake.table(CLEANED_TX, "sales_details"))
    assert {r.category for r in cleaned.collect()} == {"Clothing", "Footwear"}
    jobs.transform_daily(spark, tmp_lake, day="2025-10-20", cap=1000.0)
    fresh = read_parquet(spark, tmp_lake.table(CLEANED_TX, "sales_details"))
    assert {r.category for r in fresh.collect()} == {"new"}


def test_command_line_runs_a_stage_from_files(spark, tmp_lake, sources):
    from shelfline.__main__ import main
    from shelfline.session import fresh_path
    folder = fresh_path(spark, "cli")
    for t in jobs.TX_KEYS:
        sources.transactions(spark, t).write.parquet(f"{folder}/{t}")
    for name in ("products", "stores"):
        getattr(sources, name)(spark).write.option("header", True).csv(f"{folder}/{name}.csv")
    common = ["--lake", tmp_lake.root]
    main(["ingestion", "full", *common, "--transactions", folder, "--products", f"{folder}/products.csv",
          "--stores", f"{folder}/stores.csv", "--version", "2025-10"], spark)
    main(["transformation", "full", *common], spark)
    assert read_parquet(spark, tmp_lake.table(CLEANED_TX, "sales_details")).count() == 4
    with pytest.raises(ValueError):
        main(["ingestion", "full", *common, "--products", "x", "--stores", "y", "--version", "v"], spark)


def _layer_rows(spark, lake, where, names):
    read = (lambda t: read_parquet(spark, lake.table(where, t))) if where == CLEANED_TX else \
        (lambda t: jobs.table(spark, lake, where, t).read())
    return {t: rows(read(t).select(sorted(read(t).columns))) for t in names}


def test_cleaned_rows_and_product_days_are_written_where_they_lie(spark, tmp_lake, sources, monkeypatch):
    from shelfline.operators import skew
    from shelfline.session import fresh_path
    from shelfline.sinks import parquet
    from shelfline.sources.layout import Lake
    plans, balance = [], parquet._balanced

    def seen(*args):
        df = balance(*args)
        plans.append((set(df.columns), df._jdf.queryExecution().optimizedPlan().toString()))
        return df
    monkeypatch.setattr(parquet, "_balanced", seen)
    _full(spark, tmp_lake, sources)
    for column, other in (("VAT", "description"), ("payment_id", "method"), ("times_sold", "times_sold"),
                          ("times_sold_today", "times_sold_today")):
        written = [p for columns, p in plans if {column, other} <= columns and not ("quantity" in columns and "VAT" not in columns)]
        assert written and "RebalancePartitions" not in written[-1], column
    monkeypatch.setattr(skew, "MAX_BROADCAST", 0)   # references too large to be broadcast
    large = Lake(fresh_path(spark, "large-references"))
    _full(spark, large, sources)
    for where, names in ((CLEANED_TX, jobs.TX_KEYS), (SERVING, (*jobs.DAILY_AGGS, *jobs.MONTHLY_AGGS))):
        assert _layer_rows(spark, large, where, names) == _layer_rows(spark, tmp_lake, where, names)


def test_rows_of_other_dates_than_their_sale_are_found(spark):
    a, b = dt.date(2025, 9, 30), dt.date(2025, 10, 20)
    sales = spark.createDataFrame([(1, T[0]), (2, T[0]), (3, None), (4, None), (6, T[0])], "sale_id long, timestamp timestamp_ntz")
    held = spark.createDataFrame([(1, a), (1, a), (2, a), (2, b), (3, None), (4, None), (4, a), (5, a), (None, a), (6, None), (6, a)],
                                 "sale_id long, date date")
    assert rows(jobs._off_date(held, sales)) == [(2,), (4,), (5,), (6,), (None,)]


def _product_days(spark, lake):
    t = {n: jobs.table(spark, lake, SERVING, n).read() for n in ("daily_product_sales", "product_sales_trends")}
    return [rows(df.select(sorted(df.columns))) for df in t.values()]


def test_trends_are_taken_from_the_published_product_days(spark, tmp_lake, sources, monkeypatch):
    from shelfline import operators as op
    _full(spark, tmp_lake, sources)
    m = jobs._curated(spark, tmp_lake)
    from_fact = op.create_product_sales_trends(m["fact_sales"], m["dim_product"], m["dim_date"])
    expected = rows(from_fact.select(sorted(from_fact.columns)))
    assert expected and _product_days(spark, tmp_lake)[1] == expected
    read = []
    trends = op.create_product_sales_trends
    monkeypatch.setattr(op, "create_product_sales_trends", lambda *a, **k: read.append(trends(*a, **k)) or read[-1])
    jobs.aggregate_full(spark, tmp_lake)
    assert "line_amount" not in read[0]._jdf.queryExecution().optimizedPlan().toString()
    # a day that dim_date has twice makes groups of two rows: the fact is grouped itself
    dd = jobs.table(spark, tmp_lake, CURATED, "dim_date")
    dd.overwrite(dd.read().unionByName(dd.read()))
    jobs.aggregate_full(spark, tmp_lake)
    m = jobs._curated(spark, tmp_lake)
    from_fact = trends(m["fact_sales"], m["dim_product"], m["dim_date"])
    twice = rows(from_fact.select(sorted(from_fact.columns)))
    assert twice != expected and _product_days(spark, tmp_lake)[1] == twice
    # a fact without rows
    fact = jobs.table(spark, tmp_lake, CURATED, "fact_sales")
    products = jobs.table(spark, tmp_lake, CURATED, "dim_product")
    products.overwrite(products.read().where("false"))
    dd.overwrite(dd.read().distinct())
    jobs.aggregate_full(spark, tmp_lake)
    assert fact.read().count() == 4


def test_trading_dates_need_equal_groups(spark):
    from shelfline import operators as op
    a, b = dt.date(2025, 9, 30), dt.date(2025, 10, 20)
    dim = spark.createDataFrame([(1, a, 2025, 9), (2, b, 2025, 10)], "date_id int, date date, year int, month int")
    fact = lambda *r: spark.createDataFrame(list(r), "date date, date_id int")
    assert rows(op.trading_dates(fact((a, 1), (a, 1), (b, 2), (None, 3)), dim)) == [(a, a, 2025, 9), (b, b, 2025, 10)]
    assert op.trading_dates(fact((a, 1), (a, 2)), dim) is None
    assert op.trading_dates(fact((a, 1), (b, 1)), dim) is None
    assert op.trading_dates(fact((a, 1)), dim.unionByName(dim)) is None


def test_rows_shuffled_as_compressed_batches_are_the_same(spark, tmp_lake, sources, monkeypatch):
    from shelfline.operators import dealing, skew
    from shelfline.session import fresh_path
    from shelfline.sources.layout import Lake
    _full(spark, tmp_lake, sources)
    monkeypatch.setattr(dealing, "PACKED_FROM", 0)
    monkeypatch.setattr(skew, "MAX_BROADCAST", 0)
    packed = Lake(fresh_path(spark, "packed"))
    _full(spark, packed, sources)
    for where, names in ((CLEANED_TX, jobs.TX_KEYS), (CURATED, ("fact_sales",)), (SERVING, jobs.DAILY_AGGS)):
        assert _layer_rows(spark, packed, where, names) == _layer_rows(spark, tmp_lake, where, names)


def test_packed_rows_keep_types_and_take_fewer_bytes(spark, monkeypatch):
    from shelfline.operators import dealing
    kinds = spark.createDataFrame(
        [(1, dt.date(2025, 9, 30), T[0], None, b"x", True, 1.5, "a"), (None, None, None, None, None, None, None, None),
         (1, dt.date(2025, 9, 30), T[0], None, b"x", True, 1.5, "a"), (2, dt.date(2025, 10, 20), T[1], None, b"", False, float("nan"), "é")],
        "i int, date date, t timestamp_ntz, d decimal(10,2), b binary, f boolean, x double, s string").withColumn(
        "u", F.col("t").cast("timestamp")).withColumn("d", F.lit("1.25").cast("decimal(10,2)"))
    packed = dealing.balanced(kinds, ["date"], dealing.PACKED_FROM + 1)
    assert packed.schema == kinds.schema and "MapInArrow" in packed._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, packed.collect())) == sorted(map(str, kinds.collect()))
    nested = kinds.withColumn("a", F.array("i"))
    for other in (dealing.balanced(kinds, ["date"]), dealing.balanced(nested, ["date"], dealing.PACKED_FROM + 1)):
        assert "MapInArrow" not in other._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(dealing, "HELD_ROWS", 1000)
    many = spark.range(20_000).selectExpr("id", "concat('line-', id) as s", "date_add(DATE'2025-01-01', cast(id % 50 as int)) as date")
    packed = dealing.balanced(many, ["date"], dealing.PACKED_FROM + 1)
    assert packed.exceptAll(many).count() == 0 and packed.count() == 20_000
    # rows of a value lie in one partition
    lying = packed.groupBy("date", F.spark_partition_id()).count().groupBy("date").count()
    assert lying.where("count > 1").count() == 0
    blobs = many.withColumn(dealing._GROUP, F.lit(0)).mapInArrow(dealing._packed, f"{dealing._GROUP} int, {dealing._SIZE} long, {dealing._ROWS} binary")
    size = blobs.agg(F.sum(F.length(dealing._ROWS)).alias("n"), F.sum(dealing._SIZE).alias("raw")).first()
    assert size.n < size.raw / 2
