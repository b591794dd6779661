"""Cleaning of the transactional feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import sale_date
from ..functions.money import capped, line_amount, vat
from ..functions.quantile import median_price
from .skew import ROWS_PER_TASK, hot_keys, join_split_hot


def price_cap(sales_details: DataFrame, *, median_method: str = "approx",
              cap_factor: float = config.CAP_FACTOR,
              relative_error: float = config.QUANTILE_ERROR) -> Column:
    """cap_factor x median of all positive input prices (before any row filter)."""
    return median_price(sales_details, "unit_price", median_method, relative_error) * F.lit(float(cap_factor))


def clean_sales_details(sales_details: DataFrame, products: DataFrame, sales: DataFrame, *,
                        cap=None, median_method: str = "approx",
                        cap_factor: float = config.CAP_FACTOR, vat_rate: float = config.VAT_RATE,
                        relative_error: float = config.QUANTILE_ERROR,
                        rows_per_task: int = ROWS_PER_TASK, hot_sales: DataFrame | None = None,
                        parts: int | None = None, dated: bool = False) -> DataFrame:
    """Keep lines with quantity > 0 and unit_price > 0, cap the price at
    cap_factor x median, add VAT, the sale's date and the product attributes
    (null when the product is unknown; the line is kept).

    ``cap`` may be passed in (a number or Column) to make daily runs use the
    same cap as a full run, and ``hot_sales`` the list of
    :func:`~shelfline.operators.skew.hot_keys` of the lines, ``parts`` their
    :func:`~shelfline.operators.skew.join_parts`.  With ``dated`` the lines
    have the date of their sale already: they are not joined to ``sales``."""
    if cap is None:
        cap = price_cap(sales_details, median_method=median_method, cap_factor=cap_factor,
                        relative_error=relative_error)
    lines = sales_details.select("detail_id", "sale_id", "product_id", *(["date"] if dated else []),
                                 F.col("quantity").alias("_qty"), F.col("unit_price").alias("_price")) \
        .where((F.col("_qty") > 0) & (F.col("_price") > 0))
    prod = products.select(F.col("product_id").alias("_pid"), F.col("name").alias("product_name"),
                           "description", "category")
    day = sales.select("sale_id", sale_date("timestamp").alias("date"))
    price = capped("_price", cap)
    with_product = lines.join(prod, lines.product_id == prod._pid, "left").drop("_pid")
    if not dated:
        # the sale's date: a sale holding a large share of all lines is joined apart
        hot = hot_sales if hot_sales is not None else hot_keys(sales_details, "sale_id", rows_per_task)
        with_product = join_split_hot(with_product, day, "sale_id", "left", hot=hot, salt_by="detail_id", parts=parts)
    return with_product.select("detail_id", "sale_id", "product_id", F.col("_qty").alias("quantity"),
                               price.alias("unit_price"), vat(price, F.col("_qty"), vat_rate).alias("VAT"),
                               "date", "product_name", "description", "category")


def clean_sales(sales: DataFrame, details_cleaned: DataFrame | None, *,
                floor_total: float = config.FLOOR_TOTAL) -> DataFrame:
    """A zero total becomes the sum of its cleaned lines (price x qty + VAT),
    or floor_total when it has none; a null total stays null.  Adds ``date``.

    Lines are summed by sale first, with partial sums on the map side, so a sale
    that holds a large share of all lines reaches the join as one row.  Sales none of
    which has a zero total need no lines: ``details_cleaned`` may be None."""
    total = F.col("total_amount")
    if details_cleaned is None:
        return sales.drop("date").withColumn("date", sale_date("timestamp"))
    sums = details_cleaned.groupBy("sale_id").agg(F.sum(line_amount() + F.col("VAT")).alias("_calculated_total"))
    cols = [c for c in sales.columns if c != "date"]
    return (sales.join(sums, "sale_id", "left")
            .select(*[F.when(total == 0, F.coalesce(F.col("_calculated_total"), F.lit(floor_total)))
                      .otherwise(total).alias(c) if c == "total_amount" else F.col(c) for c in cols],
                    sale_date("timestamp").alias("date")))


def clean_payments(payments: DataFrame, sales_cleaned: DataFrame, *,
                   unknown: str = config.UNKNOWN_METHOD,
                   default: str = config.DEFAULT_METHOD,
                   rows_per_task: int = ROWS_PER_TASK, hot_sales: DataFrame | None = None,
                   dated: bool = False) -> DataFrame:
    """Keep payments whose sale exists, replace the unknown method, take the
    sale's date.  A null method stays null.  With ``dated`` all have a sale, and its date
    already: they are not joined to it."""
    m = F.col("method")
    p = payments.select("payment_id", "sale_id", "method", "amount", *([F.col("date").alias("_day")] if dated else []))
    if not dated:
        s = sales_cleaned.select("sale_id", sale_date("timestamp").alias("_day"))
        hot = hot_sales if hot_sales is not None else hot_keys(payments, "sale_id", rows_per_task)
        p = join_split_hot(p, s, "sale_id", "inner", hot=hot, salt_by="payment_id")
    return p.select("payment_id", "sale_id", F.when(m == unknown, F.lit(default)).otherwise(m).alias("method"),
                    "amount", F.col("_day").alias("date"))


def enrich_sales_with_stores(sales_cleaned: DataFrame, stores: DataFrame) -> DataFrame:
    """C4: left join the store attributes (null for an unknown store)."""
    st = stores.select("store_id", F.col("name").alias("store_name"), "address", "town",
                       "number_of_employees")
    return sales_cleaned.join(st, "store_id", "left").select(
        *sales_cleaned.columns, "store_name", "address", "town", "number_of_employees")
