"""Star schema: dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import date_key, sale_date
from ..functions.money import line_amount
from .dealing import balanced
from .skew import ROWS_PER_TASK, hot_keys, join_split_hot


# A payment method dimension of up to this many rows is broadcast.
MAX_METHODS = 10_000


def create_dim_product(details_cleaned: DataFrame) -> DataFrame:
    """Distinct product attributes of the products that were sold."""
    return details_cleaned.select("product_id", "product_name", "description", "category").distinct()


def create_dim_store(sales_enriched: DataFrame) -> DataFrame:
    """Distinct store attributes of the stores that sold (an unknown store
    enters with null attributes)."""
    return sales_enriched.select("store_id", "store_name", "address", "town",
                                 "number_of_employees").distinct()


def create_dim_date(sales: DataFrame) -> DataFrame:
    """One row per distinct sale date (not a calendar) with its parts."""
    d = F.col("date")
    return (sales.select(sale_date("timestamp").alias("date")).distinct()
            .select(date_key(d).alias("date_id"), d, F.dayofmonth(d).alias("day"),
                    F.month(d).alias("month"), F.quarter(d).alias("quarter"), F.year(d).alias("year")))


def _fact_joined(sales: DataFrame, details: DataFrame, payments: DataFrame, method: str,
                 dim_date: DataFrame, rows_per_task: int, hot_lines: DataFrame | None,
                 hot_payments: DataFrame | None, parts: int | None) -> DataFrame:
    """Lines x payments of their sale; ``method`` is the payment column to keep.
    ``parts``: :func:`~shelfline.operators.skew.join_parts` of the lines."""
    if hot_lines is None:
        hot_lines = hot_keys(details, "sale_id", rows_per_task)
    if hot_payments is None:
        hot_payments = hot_keys(payments, "sale_id", rows_per_task)
    s = sales.select("sale_id", "store_id", sale_date("timestamp").alias("_sale_date"))
    d = details.select("detail_id", "sale_id", "product_id", "quantity", "unit_price", "VAT")
    p = payments.select("payment_id", "sale_id", method)
    # one header row per sale x payment, then its lines; on both sides a sale
    # with many rows is salted
    header = join_split_hot(p, s, "sale_id", hot=hot_payments, salt_by="payment_id").drop("payment_id")
    joined = join_split_hot(d, header, "sale_id", hot=hot_lines, salt_by="detail_id", parts=parts)
    # dim_date has one row per calendar day, so its size is bounded by the
    # number of days covered (about 366 rows a year): safe to broadcast.
    dd = F.broadcast(dim_date.select("date_id", F.col("date").alias("_dd_date")))
    return joined.join(dd, F.col("_sale_date") == F.col("_dd_date"))


def create_fact_sales(sales: DataFrame, details: DataFrame, payments: DataFrame,
                      dim_date: DataFrame, *, rows_per_task: int = ROWS_PER_TASK,
                      hot_lines: DataFrame | None = None, hot_payments: DataFrame | None = None,
                      parts: int | None = None, by_date: bool = False, rows: int | None = None) -> DataFrame:
    """grain = sale line x payment of the sale.  A sale without payment has
    no fact rows; a sale with k payments has each line k times.

    With ``by_date`` the rows are shuffled to lie by date, for a write by date, before
    the columns that follow from others are added (``rows``, about how many: see :mod:`.dealing`)."""
    paid = payments.withColumnRenamed("method", "payment_method")
    joined = _fact_joined(sales, details, paid, "payment_method", dim_date, rows_per_task, hot_lines, hot_payments, parts)
    if by_date:
        joined = balanced(joined.select("sale_id", "product_id", "store_id", "date_id", "payment_method", "quantity", "unit_price",
                                        "VAT", "_sale_date"), ["_sale_date"], rows)
    return joined.select(
        "sale_id", "product_id", "store_id", "date_id", "payment_method", "quantity", "unit_price",
        line_amount().alias("line_amount"), "VAT", F.col("_sale_date").alias("date"))


def create_dim_payment_method(payments: DataFrame, existing: DataFrame | None = None, *,
                              prefix: str = config.METHOD_DESCRIPTION_PREFIX) -> DataFrame:
    """One row per payment method not yet in ``existing``; new ids follow
    the existing maximum in method order (stable across reruns)."""
    methods = payments.select("method").distinct()
    if existing is not None:
        methods = methods.join(existing.select("method"), "method", "left_anti")
        base = F.coalesce(existing.select(F.max("method_id")).scalar().cast("long"), F.lit(0).cast("long"))
    else:
        base = F.lit(0).cast("long")
    # the window has no partition key, but it runs over the distinct methods
    # only (a handful of values), never over payment rows
    rank = F.row_number().over(Window.orderBy(F.col("method").asc_nulls_first()))
    return methods.select((base + rank).alias("method_id"), "method",
                          F.concat(F.lit(prefix), F.col("method")).alias("description"))


def create_fact_sales_with_method_id(sales: DataFrame, details: DataFrame, payments: DataFrame,
                                     dim_date: DataFrame, dim_payment_method: DataFrame, *,
                                     rows_per_task: int = ROWS_PER_TASK, hot_lines: DataFrame | None = None,
                                     hot_payments: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """C8 with the payment method replaced by its dimension key (inner join).
    The key is looked up on payments, before they meet the lines.  The dimension
    is broadcast when it is counted to hold at most ``MAX_METHODS`` rows;
    payments of one method may be many, so beyond that they are salted."""
    pm = dim_payment_method.select("method", "method_id")
    if pm.limit(MAX_METHODS + 1).count() <= MAX_METHODS:
        paid = payments.join(F.broadcast(pm), "method")
    else:
        paid = join_split_hot(payments, pm, "method", hot=hot_keys(payments, "method", rows_per_task), salt_by="payment_id")
    return _fact_joined(sales, details, paid, "method_id", dim_date, rows_per_task, hot_lines, hot_payments, parts).select(
        "sale_id", "product_id", "store_id", "date_id", "method_id", "quantity", "unit_price",
        line_amount().alias("line_amount"), "VAT", F.col("_sale_date").alias("date"))
