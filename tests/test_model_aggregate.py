import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline import operators as op
from tests.conftest import rows

DAY1, DAY2 = dt.date(2025, 10, 20), dt.date(2025, 11, 3)


@pytest.fixture()
def cleaned(spark):
    sales = spark.createDataFrame([
        (1, 10, dt.datetime(2025, 10, 20, 9), 100.0, DAY1, "S1", "A1", "Tunis", 11),
        (2, 10, dt.datetime(2025, 10, 20, 12), 50.0, DAY1, "S1", "A1", "Tunis", 11),
        (3, 20, dt.datetime(2025, 11, 3, 8), 30.0, DAY2, "S2", "A2", "Sfax", 16),
        (4, 20, dt.datetime(2025, 11, 3, 9), 10.0, DAY2, "S2", "A2", "Sfax", 16),   # no payment
    ], "sale_id long, store_id int, timestamp timestamp_ntz, total_amount double, date date, "
       "store_name string, address string, town string, number_of_employees int")
    details = spark.createDataFrame([
        ("a", 1, 7, 2, 10.0, 4.0, DAY1, "Jacket", "Denim Jacket", "Clothing"),
        ("b", 1, 8, 1, 30.0, 6.0, DAY1, "Sandals", "Canvas Sandals", "Footwear"),
        ("c", 2, 7, 5, 10.0, 10.0, DAY1, "Jacket", "Denim Jacket", "Clothing"),
        ("d", 3, 8, 1, 30.0, 6.0, DAY2, "Sandals", "Canvas Sandals", "Footwear"),
        ("e", 4, 7, 1, 10.0, 2.0, DAY2, "Jacket", "Denim Jacket", "Clothing"),
    ], "detail_id string, sale_id long, product_id long, quantity int, unit_price double, VAT double, date date, "
       "product_name string, description string, category string")
    payments = spark.createDataFrame([
        (100, 1, "Card", 100.0, DAY1), (101, 2, "Cash", 25.0, DAY1), (102, 2, "Card", 25.0, DAY1),
        (103, 3, "Cash", 30.0, DAY2)],
        "payment_id long, sale_id long, method string, amount double, date date")
    return sales, details, payments


def test_dims(spark, cleaned):
    sales, details, _ = cleaned
    assert rows(op.create_dim_product(details)) == [
        (7, "Jacket", "Denim Jacket", "Clothing"), (8, "Sandals", "Canvas Sandals", "Footwear")]
    assert rows(op.create_dim_store(sales)) == [(10, "S1", "A1", "Tunis", 11), (20, "S2", "A2", "Sfax", 16)]
    dd = op.create_dim_date(sales)
    assert dd.columns == ["date_id", "date", "day", "month", "quarter", "year"]
    assert rows(dd) == [(20251020, DAY1, 20, 10, 4, 2025), (20251103, DAY2, 3, 11, 4, 2025)]


def test_fact_grain_line_times_payment(spark, cleaned):
    sales, details, payments = cleaned
    fact = op.create_fact_sales(sales, details, payments, op.create_dim_date(sales))
    assert fact.columns == ["sale_id", "product_id", "store_id", "date_id", "payment_method", "quantity",
                            "unit_price", "line_amount", "VAT", "date"]
    got = rows(fact, "sale_id", "payment_method", "line_amount")
    # sale 2 has two payments -> its line twice; sale 4 has none -> absent
    assert got == [(1, "Card", 20.0), (1, "Card", 30.0), (2, "Card", 50.0), (2, "Cash", 50.0), (3, "Cash", 30.0)]

    lying = op.create_fact_sales(sales, details, payments, op.create_dim_date(sales), by_date=True)
    assert lying.columns == fact.columns and rows(lying) == rows(fact)
    plan = lying._jdf.queryExecution().optimizedPlan().toString()
    shuffled = plan[plan.index("RebalancePartitions"):]  # columns that follow from others come after the shuffle
    assert "line_amount" in plan and "line_amount" not in shuffled


@pytest.fixture()
def star(spark, cleaned):
    sales, details, payments = cleaned
    dd = op.create_dim_date(sales)
    return (op.create_fact_sales(sales, details, payments, dd), op.create_dim_store(sales),
            op.create_dim_product(details), dd)


def test_daily_store_sales(spark, star):
    fact, ds, _, _ = star
    out = op.create_daily_store_sales(fact, ds)
    assert rows(out) == [(DAY1, 10, "S1", "Tunis", 150.0, 13, 4, 37.5), (DAY2, 20, "S2", "Sfax", 30.0, 1, 1, 30.0)]


def test_daily_product_sales_and_trends(spark, star):
    fact, _, dp, dd = star
    assert rows(op.create_daily_product_sales(fact, dp)) == [
        (DAY1, 7, "Jacket", "Clothing", 120.0, 12, 3), (DAY1, 8, "Sandals", "Footwear", 30.0, 1, 1),
        (DAY2, 8, "Sandals", "Footwear", 30.0, 1, 1)]
    tr = op.create_product_sales_trends(fact, dp, dd)
    assert tr.columns == ["product_id", "product_name", "category", "year", "month", "date", "daily_revenue",
                          "daily_quantity_sold", "times_sold_today"]
    assert rows(tr, "product_id", "date", "daily_revenue") == [(7, DAY1, 120.0), (8, DAY1, 30.0), (8, DAY2, 30.0)]


def test_monthly_metrics_and_dashboard(spark, star):
    fact, ds, _, dd = star
    assert rows(op.create_monthly_customer_metrics(fact)) == [("2025-10", 2, 150.0, 37.5), ("2025-11", 1, 30.0, 30.0)]
    sp = op.create_store_performance_dashboard(fact, ds, dd)
    assert rows(sp) == [(10, "S1", "Tunis", 2025, 10, 150.0, 13, 2, 37.5, 1, "2025-10"),
                        (20, "S2", "Sfax", 2025, 11, 30.0, 1, 1, 30.0, 1, "2025-11")]
    avg = op.create_store_performance_avg_daily(fact, ds, dd)
    assert [r.avg_daily_revenue for r in avg.collect()] == [150.0, 30.0]


def test_duplicate_dimension_rows_count_like_join_then_group(spark, star):
    fact, ds, _, _ = star
    dup = ds.unionByName(ds.where("store_id = 10").withColumn("address", F.lit("other")))
    naive = (fact.join(dup.select("store_id", "store_name", "town"), "store_id")
             .groupBy("date", "store_id", "store_name", "town").agg(F.sum("line_amount").alias("s")))
    got = op.create_daily_store_sales(fact, dup).select("date", "store_id", "daily_sales")
    assert rows(got) == rows(naive.select("date", "store_id", "s"))


def test_duplicate_product_rows_count_like_join_then_group(spark, star):
    fact, _, dp, dd = star
    dup = dp.unionByName(dp.withColumn("description", F.lit("other"))).unionByName(
        dp.where("product_id = 8").withColumn("category", F.lit(None).cast("string")))
    labels = dup.select("product_id", "product_name", "category")
    naive = (fact.join(labels, "product_id").groupBy("date", "product_id", "product_name", "category")
             .agg(F.sum("line_amount").alias("daily_revenue"), F.sum("quantity").alias("total_quantity_sold"),
                  F.count("sale_id").alias("times_sold")))
    daily = op.create_daily_product_sales(fact, dup)
    assert daily.dtypes == naive.dtypes and rows(daily) == rows(naive)
    trends = op.create_product_sales_trends(fact, dup, dd)
    assert rows(trends, "date", "product_id", "product_name", "category", "daily_revenue", "daily_quantity_sold",
                "times_sold_today") == rows(naive)
    for df in (daily, trends):  # the many groups are not grouped a second time
        assert not df._jdf.queryExecution().optimizedPlan().toString().startswith("Aggregate")


def test_partitions_of_the_fact_join_grow_with_the_lines(spark, cleaned, monkeypatch):
    from shelfline.operators import skew
    sales, details, payments = cleaned
    assert skew.join_parts(details) is None
    dd = op.create_dim_date(sales)
    plain = op.create_fact_sales(sales, details, payments, dd)
    monkeypatch.setattr(skew, "ROWS_PER_PART", 1000)
    parts = skew.join_parts(spark.range(200_000))
    assert parts == 200
    split = op.create_fact_sales(sales, details, payments, dd, parts=parts)
    assert "hashpartitioning(sale_id" in split._jdf.queryExecution().executedPlan().toString()
    assert ", 200), REPARTITION_BY_NUM" in split._jdf.queryExecution().executedPlan().toString()
    assert rows(split) == rows(plain)


def test_sum_of_daily_equals_sum_of_monthly(spark, star):
    fact, ds, _, dd = star
    a = op.create_daily_store_sales(fact, ds).agg(F.sum("daily_sales")).collect()[0][0]
    b = op.create_store_performance_dashboard(fact, ds, dd).agg(F.sum("monthly_revenue")).collect()[0][0]
    assert a == b == 180.0


def test_dim_payment_method_incremental(spark, cleaned):
    _, _, payments = cleaned
    first = op.create_dim_payment_method(payments.where("method = 'Cash'"))
    assert rows(first) == [(1, "Cash", "Payment via Cash")]
    more = op.create_dim_payment_method(payments, first)
    assert rows(more) == [(2, "Card", "Payment via Card")]


def test_fact_with_method_id(spark, cleaned):
    sales, details, payments = cleaned
    dpm = op.create_dim_payment_method(payments)
    f = op.create_fact_sales_with_method_id(sales, details, payments, op.create_dim_date(sales), dpm)
    assert "method_id" in f.columns and "payment_method" not in f.columns
    assert f.count() == 5


def test_salted_fact_join_equals_plain_join(spark):
    from pyspark.sql import functions as F
    n = 2000
    sales = spark.range(n).select(F.col("id").alias("sale_id"), (F.col("id") % 5).cast("int").alias("store_id"),
                                  F.lit(dt.datetime(2025, 10, 20, 9)).cast("timestamp_ntz").alias("timestamp"),
                                  F.lit(1.0).alias("total_amount"))
    # sale 0 holds a third of all lines and has two payments
    details = spark.range(3 * n).select(F.col("id").cast("string").alias("detail_id"),
                                        F.when(F.col("id") < n, 0).otherwise(F.col("id") % n).alias("sale_id"),
                                        (F.col("id") % 9).alias("product_id"), F.lit(1).alias("quantity"),
                                        (F.col("id") % 7 + 1.0).alias("unit_price"), F.lit(0.2).alias("VAT"))
    payments = spark.createDataFrame([(i, i, "Card", 1.0) for i in range(n)] + [(-1, 0, "Cash", 1.0)],
                                     "payment_id long, sale_id long, method string, amount double")
    dd = op.create_dim_date(sales)
    salted = op.create_fact_sales(sales, details, payments, dd, rows_per_task=100)
    plain = op.create_fact_sales(sales, details, payments, dd, rows_per_task=10**12)
    # sale 0: n + 2 lines x 2 payments; the other sales: 2n - 2 lines x 1 payment
    assert salted.count() == plain.count() == 4 * n + 2
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_product_days_in_parts_of_a_day_give_the_same_rows(spark, monkeypatch):
    from shelfline.operators import skew
    monkeypatch.setattr(skew, "ROWS_PER_PART", 3)
    days = [dt.date(2025, 9, 30), dt.date(2025, 10, 1), None]
    data = [(i, i % 3, None if i % 11 == 10 else i % 7, 20250930 + i % 2, 1, 2.0 + i, days[i % 3]) for i in range(60)]
    fact = spark.createDataFrame(data, "sale_id long, store_id int, product_id long, date_id int, quantity int, line_amount double, date date")
    dim_product = spark.createDataFrame([(i, f"p{i}", "c") for i in range(6)] + [(2, "p2", "c"), (3, "other", "c")],
                                        "product_id long, product_name string, category string")
    dim_date = spark.createDataFrame([(20250930, days[0], 9, 2025), (20250931, days[1], 10, 2025)], "date_id int, date date, month int, year int")
    parts = skew.day_parts(fact)
    assert {r._day: r._parts for r in parts.collect()} == {d: 7 for d in days}
    for build in (lambda **kw: op.create_daily_product_sales(fact, dim_product, **kw),
                  lambda **kw: op.create_product_sales_trends(fact, dim_product, dim_date, **kw)):
        placed = build(days=parts)
        assert rows(placed) == rows(build())
        plan = placed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning(") - plan.count("Exchange hashpartitioning(product_id") == 1  # labels are grouped by product
