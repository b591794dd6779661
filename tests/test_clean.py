import datetime as dt

import pytest

from shelfline import operators as op
from shelfline.schemas import PAYMENTS, SALES, SALES_DETAILS
from tests.conftest import rows

D1 = dt.datetime(2025, 10, 20, 9, 30)
D2 = dt.datetime(2025, 10, 21, 18, 0)


@pytest.fixture()
def tables(spark):
    sales = spark.createDataFrame([
        (1, 10, D1, 100.0),
        (2, 10, D1, 0.0),     # zero total, has lines -> recomputed
        (3, 20, D2, 0.0),     # zero total, no valid lines -> 0.01
        (4, 99, D2, None),    # null total stays null; unknown store
        (5, 20, D2, 55.5),
    ], SALES)
    details = spark.createDataFrame([
        ("a", 1, 7, 2, 10.0),
        ("b", 2, 7, 1, 10.0),
        ("c", 2, 8, 3, 1000.0),   # above 5 x median -> capped
        ("d", 3, 7, 0, 10.0),     # zero quantity -> dropped
        ("e", 3, 7, 2, -1.0),     # negative price -> dropped
        ("f", 5, 9, 1, 20.0),     # unknown product -> kept, null attributes
        ("g", 5, 7, None, 20.0),  # null quantity -> dropped
        ("h", 1, 8, 1, 50.0),     # exactly 5 x median -> not capped
    ], SALES_DETAILS)
    products = spark.createDataFrame([(7, "Jacket", "Denim Jacket", "Clothing", 5.0),
                                      (8, "Sandals", "Canvas Sandals", "Footwear", 9.0)],
                                     "product_id long, name string, description string, category string, unit_price double")
    stores = spark.createDataFrame([(10, "Store, One", "1 Main St", "Tunis", 11),
                                    (20, "Store Two", "2 Side St", "Sfax", 16)],
                                   "store_id int, name string, address string, town string, number_of_employees int")
    payments = spark.createDataFrame([(100, 1, "Unknown", 100.0), (101, 2, "Cash", 1.0), (102, 3, None, 0.01),
                                      (103, 777, "Card", 5.0)], PAYMENTS)
    return sales, details, products, stores, payments


def test_clean_sales_details(spark, tables):
    sales, details, products, *_ = tables
    # positive prices: 10,10,1000,10,20,20,50 -> median 20 -> cap 100
    out = op.clean_sales_details(details, products, sales, median_method="exact")
    assert out.columns == ["detail_id", "sale_id", "product_id", "quantity", "unit_price", "VAT", "date",
                           "product_name", "description", "category"]
    got = {r.detail_id: r for r in out.collect()}
    assert sorted(got) == ["a", "b", "c", "f", "h"]
    assert got["c"].unit_price == 100.0 and got["c"].VAT == 60.0
    assert got["h"].unit_price == 50.0 and got["h"].VAT == 10.0
    assert got["a"].VAT == 4.0 and got["a"].date == dt.date(2025, 10, 20)
    assert got["f"].product_name is None and got["f"].category is None
    assert got["a"].product_name == "Jacket"


def test_clean_sales_details_fixed_cap_and_empty(spark, tables):
    sales, details, products, *_ = tables
    out = op.clean_sales_details(details, products, sales, cap=15.0)
    assert {r.detail_id: r.unit_price for r in out.collect()}["f"] == 15.0
    empty = details.where("unit_price > 1e9")
    assert op.clean_sales_details(empty, products, sales).count() == 0


def test_clean_sales(spark, tables):
    sales, details, products, *_ = tables
    d = op.clean_sales_details(details, products, sales, median_method="exact")
    out = op.clean_sales(sales, d)
    assert out.columns == ["sale_id", "store_id", "timestamp", "total_amount", "date"]
    got = {r.sale_id: r.total_amount for r in out.collect()}
    # sale 2: 10*1 + 2.0 (VAT) + 100*3 + 60.0 = 372
    assert got == {1: 100.0, 2: 372.0, 3: 0.01, 4: None, 5: 55.5}


def test_clean_payments(spark, tables):
    sales, *_, payments = tables
    out = op.clean_payments(payments, sales)
    assert out.columns == ["payment_id", "sale_id", "method", "amount", "date"]
    assert rows(out, "payment_id", "method", "date") == [
        (100, "Card", dt.date(2025, 10, 20)), (101, "Cash", dt.date(2025, 10, 20)), (102, None, dt.date(2025, 10, 21))]


def test_enrich_sales(spark, tables):
    sales, _, _, stores, _ = tables
    out = op.enrich_sales_with_stores(sales, stores)
    assert out.columns == sales.columns + ["store_name", "address", "town", "number_of_employees"]
    got = {r.sale_id: (r.store_name, r.town) for r in out.collect()}
    assert got[1] == ("Store, One", "Tunis") and got[4] == (None, None)
