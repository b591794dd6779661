"""The joins on sale_id (J1, J2, J4, J5, J6, J8) over tables bucketed by sale_id.

Every step keeps the partitioning of the buckets, so none of them shuffles
lines, payments or sales.  The product attributes (a join on another key) are left
to the readers of the result: the fact does not need them.

A sale that holds more lines than one task should take would make its bucket the
last task to end; such sales (``hot``) go through the salted joins of
:mod:`shelfline.operators.skew` instead, and the two parts are put together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import sale_date
from ..functions.money import capped, line_amount, vat
from .clean import price_cap
from .model import create_fact_sales
from .skew import ROWS_PER_TASK


def dated_children(children: DataFrame, sales: DataFrame) -> DataFrame:
    """Lines or payments of known sales with the sale's date."""
    return children.join(sales.select("sale_id", sale_date("timestamp").alias("date")), "sale_id")


def priced_lines(details: DataFrame, *, cap=None, median_method: str = "approx", vat_rate: float = config.VAT_RATE) -> DataFrame:
    """The lines of C1 with capped price and VAT, without date and product attributes."""
    if cap is None:
        cap = price_cap(details, median_method=median_method)
    price = capped("unit_price", cap)
    return details.where((F.col("quantity") > 0) & (F.col("unit_price") > 0)).select(
        "detail_id", "sale_id", "product_id", "quantity", price.alias("unit_price"),
        vat(price, F.col("quantity"), vat_rate).alias("VAT"))


def line_sums(lines: DataFrame) -> DataFrame:
    """A4: per sale, what its lines come to; grouped inside the buckets."""
    return lines.groupBy("sale_id").agg(F.sum(line_amount() + F.col("VAT")).alias("line_sum"), F.count(F.lit(1)).alias("lines"))


def sale_totals(sales: DataFrame, lines: DataFrame, *, floor_total: float = config.FLOOR_TOTAL) -> DataFrame:
    """C2 by J5: zero totals from the line sums; adds ``date``."""
    total = F.col("total_amount")
    repaired = F.when(total == 0, F.coalesce(F.col("line_sum"), F.lit(floor_total))).otherwise(total)
    columns = [repaired.alias(c) if c == "total_amount" else F.col(c) for c in sales.columns if c != "date"]
    return sales.join(line_sums(lines), "sale_id", "left").select(*columns, sale_date("timestamp").alias("date"))


def paid_sales(payments: DataFrame, sales: DataFrame, *, unknown: str = config.UNKNOWN_METHOD,
               default: str = config.DEFAULT_METHOD) -> DataFrame:
    """C3 by J6: payments of known sales, the unknown method replaced."""
    m = F.col("method")
    return payments.join(sales.select("sale_id", sale_date("timestamp").alias("_day")), "sale_id").select(
        "payment_id", "sale_id", F.when(m == unknown, F.lit(default)).otherwise(m).alias("method"), "amount",
        F.col("_day").alias("date"))


def hot_sales(details: DataFrame, payments: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> list:
    """Sales with more lines or payments than one task should take: at most one for
    every ``rows_per_task`` rows.  Counted inside the buckets, without a shuffle."""
    out: set = set()
    for df in (details, payments):
        counts = df.groupBy("sale_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_task)
        out.update(r.sale_id for r in counts.where("sale_id IS NOT NULL").select("sale_id").collect())
    return sorted(out)


def colocated_fact(sales: DataFrame, lines: DataFrame, payments: DataFrame, dim_date: DataFrame, *,
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """C8 by J8 over bucketed tables: the rows of
    :func:`~shelfline.operators.model.create_fact_sales`.  ``payments`` are cleaned."""
    hot = hot_sales(lines, payments, rows_per_task)

    def joined(s: DataFrame, d: DataFrame, p: DataFrame) -> DataFrame:
        # dim_date has one row per calendar day: safe to broadcast
        dd = F.broadcast(dim_date.select("date_id", F.col("date").alias("_dd_date")))
        header = p.select("sale_id", F.col("method").alias("payment_method")).join(
            s.select("sale_id", "store_id", sale_date("timestamp").alias("_sale_date")), "sale_id")
        return d.join(header, "sale_id").join(dd, F.col("_sale_date") == F.col("_dd_date")).select(
            "sale_id", "product_id", "store_id", "date_id", "payment_method", "quantity", "unit_price",
            line_amount().alias("line_amount"), "VAT", F.col("_sale_date").alias("date"))

    if not hot:
        return joined(sales, lines, payments)
    is_hot = F.col("sale_id").isin(hot)
    usual = joined(*(df.where(~is_hot) for df in (sales, lines, payments)))
    apart = create_fact_sales(*(df.where(is_hot) for df in (sales, lines, payments)), dim_date, rows_per_task=rows_per_task)
    return usual.unionByName(apart)
