"""Bucketed tables, pruning by dimension, daily states, versions, key index."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline import operators as op
from shelfline.operators import asof, colocated, pruning, states
from shelfline.plans import catalog_storage as storage
from shelfline.plans import jobs
from shelfline.session import fresh_path, stored
from shelfline.sinks import parquet
from shelfline.sinks.bucketed import read_bucketed, write_bucketed
from shelfline.sinks.keyindex import KeyIndex
from shelfline.sources import retail
from shelfline.sources.factory import make_sources
from shelfline.sources.files import read_csv_checked
from tests.conftest import SF001, rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_joins_on_buckets_need_no_shuffle(spark, no_broadcast):
    for query in (storage.q_bucketed_fact_sales, storage.q_bucketed_clean_sales, storage.q_bucketed_clean_payments,
                  storage.q_bucketed_ingest_details, storage.q_bucketed_ingest_payments):
        plan = _plan(query(spark, SF001))
        assert "SortMergeJoin" in plan and "hashpartitioning(sale_id" not in plan
    i = retail.retail_inputs(spark, SF001)
    assert "hashpartitioning(sale_id" in _plan(colocated.paid_sales(i.payments, i.sales))


def test_hot_sales_give_the_same_fact(spark):
    b = storage.sale_buckets(spark, SF001, 4)
    i = retail.retail_inputs(spark, SF001)
    lines, paid = colocated.priced_lines(b["sales_details"], cap=100.0), colocated.paid_sales(b["payments"], b["sales"])
    days = op.create_dim_date(i.sales)
    assert colocated.hot_sales(lines, paid, 6)
    split = colocated.colocated_fact(b["sales"], lines, paid, days, rows_per_task=6)
    plain = op.create_fact_sales(i.sales, colocated.priced_lines(i.sales_details, cap=100.0), paid, days)
    assert rows(split) == rows(plain)


def test_buckets_survive_the_session_catalog(spark):
    df = spark.createDataFrame([(i % 5, None if i == 3 else i) for i in range(40)], "v int, k long")
    path = fresh_path(spark, "buckets")
    write_bucketed(df, path, "k", 4)
    assert rows(read_bucketed(spark, path, "k", 4)) == rows(df)
    write_bucketed(df.where("k < 3"), path, "k", 4)  # overwritten
    assert read_bucketed(spark, path, "k", 4).count() == 3
    write_bucketed(df.where("false"), path, "k", 4)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


FACT = ("sale_id long, product_id long, store_id int, date_id int, payment_method string, quantity int, "
        "unit_price double, line_amount double, VAT double, date date")


def _fact(spark, n=400):
    start = dt.date(2025, 1, 25)
    made = []
    for i in range(n):
        day = start + dt.timedelta(days=i % 20)
        made.append((None if i % 50 == 9 else (i % 37) * 4001 - 60_000, i % 5, i % 3 if i % 11 else None,
                     int(day.strftime("%Y%m%d")), "Card", i % 4, 2.0, None if i % 23 == 4 else i / 4, 0.1, day))
    return spark.createDataFrame(made, FACT)


def test_only_chosen_days_are_read(spark):
    fact = _fact(spark)
    path = fresh_path(spark, "pruned-fact")
    parquet.write_partitioned(fact, path, "date")
    days = spark.read.parquet(_written(spark, fact))
    table = spark.read.parquet(path)
    chosen = F.col("day") == 27
    out = pruning.fact_of_dates(table, days, chosen, ("day",))
    assert "dynamicpruning" in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "dynamicpruning" in _plan(out).lower()
    expected = fact.where(F.dayofmonth("date") == 27)
    assert rows(out.select(fact.columns)) == rows(expected)
    sums = pruning.revenue_by(table, days, "month = 2", ("month",))
    assert "dynamicpruning" in _plan(sums).lower()
    assert sums.agg(F.sum("fact_rows")).first()[0] == fact.where(F.month("date") == 2).count()
    assert pruning.fact_of_dates(table, days, F.lit(False)).count() == 0


def _written(spark, fact):
    path = fresh_path(spark, "pruned-days")
    op.create_dim_date(fact.select(F.col("date").cast("timestamp").alias("timestamp"))).write.parquet(path)
    return path


def test_states_equal_distinct_counts(spark):
    fact = _fact(spark)
    stores = spark.createDataFrame([(0, "a", "t"), (1, "b", "t"), (1, "b2", "t"), (2, "c", None)], "store_id int, store_name string, town string")
    days = op.create_dim_date(fact.select(F.col("date").cast("timestamp").alias("timestamp")))
    kept = states.sales_states(fact)
    months = ("month_year", "total_transactions", "monthly_revenue", "avg_sale_amount")
    assert rows(states.monthly_metrics(kept), *months) == rows(op.create_monthly_customer_metrics(fact), *months)
    columns = ("store_id", "store_name", "month_year", "monthly_revenue", "total_items_sold", "transaction_count", "trading_days")
    assert rows(states.store_dashboard(kept, stores), *columns) == rows(
        op.create_store_performance_dashboard(fact, stores, days), *columns)
    assert states.monthly_metrics(states.sales_states(fact.where("false"))).count() == 0


def test_states_of_scattered_sales_are_numbers(spark):
    """Ids that do not grow with time leave one sale in most bitmaps; negative and null ids count too."""
    fact = spark.range(300).select(
        F.when(F.col("id") % 50 != 7, (F.col("id") - 100) * 104_729).alias("sale_id"), F.lit(1).alias("store_id"),
        F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("id") % 40).cast("int")).alias("date"),
        F.lit(2.0).alias("line_amount"), F.lit(1).alias("quantity"))
    kept = states.sales_states(fact.unionByName(fact))
    assert dict(kept.dtypes)["sales"] == "bigint" and "SortAggregate" not in _plan(kept)
    assert kept.count() <= 300
    months = ("month_year", "total_transactions", "monthly_revenue")
    assert rows(states.monthly_metrics(kept), *months) == rows(op.create_monthly_customer_metrics(fact.unionByName(fact)), *months)
    assert "SortAggregate" not in _plan(states.monthly_metrics(kept))


def test_a_changed_day_changes_its_state_only(spark):
    fact = _fact(spark)
    day = dt.date(2025, 2, 3)
    changed = fact.withColumn("line_amount", F.when(F.col("date") == F.lit(day), 1.0).otherwise(F.col("line_amount")))
    path = fresh_path(spark, "states")
    parquet.write_partitioned(states.sales_states(fact), path, "date")
    parquet.replace_partitions(states.sales_states(changed.where(F.col("date") == F.lit(day))), path, "date", [day])
    kept = spark.read.parquet(path)
    assert rows(states.monthly_metrics(kept)) == rows(states.monthly_metrics(states.sales_states(changed)))
    assert "line_amount" not in _plan(states.monthly_metrics(kept))  # the fact is not read


def test_history_median_has_a_small_rank_error(spark):
    df = spark.range(40_000).select(
        F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("id") % 60).cast("int")).alias("date"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100.0 - 1).alias("unit_price"))
    kept = stored(states.price_states(df), "test-prices")
    assert kept.count() == 60
    m = states.history_median(kept)
    positive = df.where("unit_price > 0")
    share = positive.where(F.col("unit_price") <= m).count() / positive.count()
    assert abs(share - 0.5) < 0.01
    assert spark.range(1).select(states.history_cap(kept.where("false"))).first()[0] is None
    lines = df.select(F.col("date").cast("string").alias("detail_id"), F.lit(1).cast("long").alias("sale_id"),
                      F.lit(1).cast("long").alias("product_id"), F.lit(1).alias("quantity"), "unit_price")
    capped = colocated.priced_lines(lines, cap=states.history_cap(kept, cap_factor=1))
    assert abs(capped.where(F.col("unit_price") <= m * 1.02).count() / positive.count() - 1) < 0.02


def test_each_row_sees_the_version_of_its_month(spark):
    versions = spark.createDataFrame(
        [("2025-02", 1, "old"), ("2025-02", 2, "two"), ("2025-04", 1, "new"), ("2025-04", 1, "twin"), ("2025-09", 1, "late")],
        "version string, product_id int, name string")
    facts = spark.createDataFrame(
        [(1, 1, dt.date(2025, 1, 31)), (2, 1, dt.date(2025, 2, 1)), (3, 2, dt.date(2025, 3, 9)), (4, 2, dt.date(2025, 4, 1)),
         (5, 1, dt.date(2025, 8, 1)), (6, None, dt.date(2025, 8, 1)), (7, 1, None)], "id int, product_id int, date date")
    got = {(r.id, r.name, r.version) for r in asof.join_as_of(facts, versions, "product_id").collect()}
    assert got == {(1, None, None), (2, "old", "2025-02"), (3, "two", "2025-02"), (4, None, "2025-04"), (5, "new", "2025-04"),
                   (5, "twin", "2025-04"), (6, None, "2025-04"), (7, None, None)}
    assert asof.join_as_of(facts, versions.where("false"), "product_id").count() == 7
    assert asof.join_as_of(facts.where("false"), versions, "product_id").count() == 0


def test_key_index_reads_keys_of_the_range_only(spark):
    index = KeyIndex(spark, fresh_path(spark, "index"), "sale_id", range_keys=100)
    history = spark.range(1000).select(F.col("id").alias("sale_id"), F.lit(dt.date(2025, 1, 1)).alias("date"), F.lit("x").alias("v"))
    assert index.unseen(history).count() == 1000  # no index yet
    index.add(history)
    index.add(history.withColumn("date", F.lit(dt.date(2025, 5, 5))))
    assert index.known(history).count() == 1000
    increment = spark.createDataFrame([(250, dt.date(2025, 1, 2), "a"), (299, dt.date(2025, 1, 1), "b"), (None, dt.date(2025, 1, 2), "c")],
                                      "sale_id long, date date, v string")
    assert sorted(r.v for r in index.unseen(increment).collect()) == ["b", "c"]
    known = index.known(increment)
    plan = _plan(known)
    assert "PartitionFilters: [isnotnull(key_range" in plan and "(key_range" in plan and "<= 2)" in plan
    assert "PushedFilters: [IsNotNull(sale_id), GreaterThanOrEqual(sale_id,250)" in plan


def test_daily_ingest_takes_a_replayed_sale_once(spark, tmp_lake):
    day = [dt.datetime(2025, 10, 20, 9), dt.datetime(2025, 10, 21, 9)]
    first = [(1, 1, day[0], 5.0), (2, 1, day[0], 6.0)]
    later = [(2, 1, day[1], 7.0), (3, 1, day[1], 8.0)]

    def source(sales):
        made = {"sales": spark.createDataFrame(sales, "sale_id long, store_id int, timestamp timestamp_ntz, total_amount double"),
                "sales_details": spark.createDataFrame([(str(s[0]), s[0], 7, 1, 2.0) for s in sales],
                                                       "detail_id string, sale_id long, product_id long, quantity int, unit_price double"),
                "payments": spark.createDataFrame([(s[0], s[0], "Card", 1.0) for s in sales], "payment_id long, sale_id long, method string, amount double")}
        return jobs.Sources(lambda spark, t: made[t], None, None)

    for _ in range(2):  # a day can be run again
        jobs.run("ingestion", "daily", spark, tmp_lake, src=source(first), day="2025-10-20", unique=True)
        jobs.run("ingestion", "daily", spark, tmp_lake, src=source(later), day="2025-10-21", unique=True)
        for t in ("sales", "sales_details"):
            raw = spark.read.parquet(tmp_lake.table(jobs.RAW_TX, t))
            assert rows(raw.select("sale_id", F.dayofmonth("date"))) == [(1, 20), (2, 20), (3, 21)]


def test_write_audit_needs_no_second_read(spark):
    fact = _fact(spark)
    path = fresh_path(spark, "audited")
    audit = op.WriteAudit()
    parquet.write_partitioned(fact, path, "date", observe=audit)
    assert rows(audit.frame(spark)) == rows(op.audit_counts(spark.read.parquet(path)))
    plan = op.WriteAudit()(fact.hint("rebalance", "date"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("RebalancePartitions")  # counted after the shuffle
    assert "FileScan" not in _plan(audit.frame(spark))
    day = dt.date(2025, 2, 3)
    for part in (fact.where(F.col("date") == F.lit(day)), fact.where("false")):  # then the day is cleared
        audit = op.WriteAudit()
        parquet.replace_partitions(part, path, "date", [day], observe=audit)
        now = spark.read.parquet(path).where(F.col("date") == F.lit(day))
        assert rows(audit.frame(spark)) == rows(op.audit_counts(now))
    assert rows(audit.frame(spark)) == [(0, 0, None, None)]


def test_checked_csv_tells_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id,name,price\n1,"a, ""b""",2.5\n2,b\n3,c,free\n4,d,1,more\n,e,5\n6,,\n7,f,1,\nx,g,y\n"9,h,1\n')
    (tmp_path / "b.csv").write_text("id,name,price\n")
    got = read_csv_checked(spark, str(tmp_path), spark.range(0).selectExpr("id", "'' AS name", "0D AS price").schema, "id")
    assert rows(got.kept) == [(1, 'a, "b"', 2.5), (6, None, None)]
    assert rows(got.rejected) == sorted([
        ("2,b", "wrong number of fields"), ("3,c,free", "price: not double"), ("4,d,1,more", "wrong number of fields"),
        ('{"name":"e","price":5.0}', "no id"), ("7,f,1,", "wrong number of fields"),
        ("x,g,y", "id: not bigint, price: not double"), ('"9,h,1', got.rejected.where("line like '%9,h%'").first().reason)])
    empty = read_csv_checked(spark, str(tmp_path / "b.csv"), got.kept.schema, "id")
    assert empty.kept.count() == empty.rejected.count() == 0


def test_full_ingest_keeps_rejected_lines_apart(spark, tmp_lake, tmp_path):
    products, stores = str(tmp_path / "p.csv"), str(tmp_path / "s.csv")
    with open(products, "w") as f:
        f.write("product_id,name,description,category,unit_price\nP1,a,b,c,1.5\nP2,a,b,c,cheap\n")
    with open(stores, "w") as f:
        f.write('store_id,name,address,town,number_of_employees\nS1,"a, b",c,d,5\n')
    tables = {"sales": "sale_id long, store_id int, timestamp timestamp_ntz, total_amount double",
              "sales_details": "detail_id string, sale_id long, product_id string, quantity int, unit_price double",
              "payments": "payment_id long, sale_id long, method string, amount double"}
    src = make_sources(lambda spark, t: spark.createDataFrame([], tables[t]), products, stores, checked=True)
    for _ in range(2):
        jobs.run("ingestion", "full", spark, tmp_lake, src=src, version="2025-07")
        assert rows(spark.read.parquet(tmp_lake.table(jobs.RAW_REF, "products", "2025-07"))) == [("P1", "a", "b", "c", 1.5)]
        assert rows(spark.read.parquet(tmp_lake.table(jobs.RAW_REJECTED, "products", "2025-07"))) == [
            ("P2,a,b,c,cheap", "unit_price: not double")]
    with pytest.raises(FileExistsError):
        jobs.run("ingestion", "monthly", spark, tmp_lake, src=src, version="2025-07")
