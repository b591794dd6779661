import datetime as dt
import math
import struct

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.functions import dates, money, quantile
from tests.conftest import rows


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2025, 7, 5),), (dt.date(1999, 12, 31),)], "date date")
    out = df.select(dates.date_key().alias("k"), dates.month_label().alias("m"),
                    dates.month_of_parts(F.year("date"), F.month("date")).alias("m2"))
    assert rows(out) == [(19991231, "1999-12", "1999-12"), (20250705, "2025-07", "2025-07")]
    assert out.schema["k"].dataType.typeName() == "integer"


def test_month_range_and_day_window():
    assert dates.month_range("2025-12") == (dt.date(2025, 12, 1), dt.date(2026, 1, 1))
    assert dates.month_range("2024-02") == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))
    lo, hi = dates.day_window("2025-10-20")
    assert (lo, hi) == (dt.datetime(2025, 10, 20), dt.datetime(2025, 10, 21))


def test_in_window_half_open(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 10, 19, 23, 59),), (dt.datetime(2025, 10, 20),),
                                (dt.datetime(2025, 10, 20, 23, 59, 59),), (dt.datetime(2025, 10, 21),)],
                               "ts timestamp_ntz")
    lo, hi = dates.day_window("2025-10-20")
    assert df.where(dates.in_window(df, "ts", lo, hi)).count() == 2


def test_vat_rounds_half_up_in_double(spark):
    df = spark.createDataFrame([(10.0, 3), (0.125, 1), (1.0, 0)], "unit_price double, quantity int")
    got = [r[0] for r in df.select(money.vat().alias("v")).collect()]
    assert got == [6.0, 0.03, 0.0]


def test_capped_keeps_prices_when_cap_is_null(spark):
    df = spark.createDataFrame([(5.0,), (50.0,)], "p double")
    assert rows(df.select(money.capped("p", 10.0).alias("c"))) == [(5.0,), (10.0,)]
    assert rows(df.select(money.capped("p", F.lit(None).cast("double")).alias("c"))) == [(5.0,), (50.0,)]


def test_capped_decimal_price_becomes_double(spark):
    df = spark.createDataFrame([(1,)], "x int").select(F.lit(12.5).cast("decimal(10,2)").alias("p"))
    out = df.select(money.capped("p", 10.0).alias("c"))
    assert out.schema["c"].dataType.typeName() == "double"
    assert out.collect()[0][0] == 10.0


def _bits(x):
    b = struct.unpack(">q", struct.pack(">d", abs(x)))[0]
    return 0 if x == 0 else (b if x > 0 else -b - 1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=1, max_size=60))
def test_order_key_is_ieee_order(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = quantile.with_order_key(df, "x", "k").collect()
    for r in got:
        assert r.k == _bits(r.x)


def test_exact_quantile_matches_sorted_rank(spark):
    rng = np.random.default_rng(7)
    xs = list(rng.lognormal(3, 2, 2000)) + [42.0] * 700 + [-1.5, 0.0]
    df = spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "x double")
    s = sorted(xs)
    for q in (0.5, 0.25, 0.99, 0.0, 1.0):
        assert quantile.exact_quantile(df, "x", q) == s[max(1, math.ceil(q * len(s))) - 1]


def test_exact_quantile_empty_is_none(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantile.exact_quantile(df, "x") is None


def test_median_price_methods(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 102)] + [(-3.0,), (0.0,)], "unit_price double")
    exact = spark.range(1).select(quantile.median_price(df, method="exact").alias("m")).collect()[0][0]
    approx = spark.range(1).select(quantile.median_price(df, method="approx").alias("m")).collect()[0][0]
    assert exact == 51.0
    assert abs(approx - 51.0) <= 0.05 * 101 + 1
    empty = df.where("unit_price > 1000")
    assert spark.range(1).select(quantile.median_price(empty, method="approx").alias("m")).collect()[0][0] is None
