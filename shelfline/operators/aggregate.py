"""Serving aggregates over the fact.

Where a dimension is joined only to label groups (G1, G2, G5) the fact is
aggregated on its keys first and the small result is joined and re-grouped:
the join then never sees fact rows, and a hot store or product is reduced
map-side before any shuffle.  The re-grouping keeps the exact semantics of a
join-then-aggregate, including duplicate dimension rows.  Products make nearly as
many groups as there are fact rows, so G2 and G5 count duplicate product rows first
and weigh the sums by that number: the groups need no second aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label, month_of_parts
from ..session import stored
from .skew import shuffled, with_part


def _pre(fact: DataFrame, keys: list[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.sum("line_amount").alias("_amt"), F.sum("quantity").alias("_qty"),
        F.count("sale_id").alias("_n"), F.count("line_amount").alias("_nl"))


def _avg():
    """Average of the amounts behind partial sums; null without any."""
    return F.try_divide(F.sum("_amt"), F.sum("_nl"))


def create_daily_store_sales(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    """G1: per date and store.  transaction_count counts fact rows (lines)."""
    pre = _pre(fact, ["date", "store_id"])
    ds = dim_store.select("store_id", "store_name", "town")
    return (pre.join(ds, "store_id")
            .groupBy("date", "store_id", "store_name", "town")
            .agg(F.sum("_amt").alias("daily_sales"), F.sum("_qty").alias("total_items_sold"),
                 F.sum("_n").alias("transaction_count"),
                 _avg().alias("avg_transaction_value")))


def _by_product(fact: DataFrame, keys: list[str], day: str, parts: int | None, days: DataFrame | None) -> DataFrame:
    """Partial sums by ``keys``, the product and the ``day`` among them.  With ``days``
    (:func:`~shelfline.operators.skew.day_parts` of the fact) rows are dealt by day and, in
    large days, by product, and the sums lie by day."""
    if days is None:
        return _pre(fact, keys)
    rows = with_part(fact.select(*keys, "line_amount", "quantity", "sale_id"), days, day, "product_id")
    return _pre(shuffled(rows, parts, day, "_part"), [*keys, "_part"]).drop("_part")


def _labelled(pre: DataFrame, dim_product: DataFrame, parts: int | None, placed: bool = False) -> DataFrame:
    """``pre`` (one row per product and day) with each distinct label of its product;
    sums and counts are those of a join with every row of that label.  ``parts``:
    :func:`~shelfline.operators.skew.join_parts` of the fact.  ``placed``: the labels are
    few and broadcast, so the rows stay where they are."""
    labels = dim_product.groupBy("product_id", "product_name", "category").agg(F.count(F.lit(1)).alias("_times"))
    sums = {c: (F.col(c) * F.col("_times")).cast(pre.schema[c].dataType) for c in ("_amt", "_qty", "_n")}
    if placed:
        labels = F.broadcast(labels)
    elif parts:
        pre, labels = pre.repartition(parts, "product_id"), labels.repartition(parts, "product_id")
    return pre.join(labels, "product_id").withColumns(sums)


def create_daily_product_sales(fact: DataFrame, dim_product: DataFrame, *, parts: int | None = None,
                               days: DataFrame | None = None) -> DataFrame:
    """Per date and product.  With ``days`` (see :func:`_by_product`) the products are
    broadcast and the rows lie by date."""
    pre = _by_product(fact, ["date", "product_id"], "date", parts, days)
    return _labelled(pre, dim_product, parts, days is not None).select(
        "date", "product_id", "product_name", "category", F.col("_amt").alias("daily_revenue"),
        F.col("_qty").alias("total_quantity_sold"), F.col("_n").alias("times_sold"))


def create_monthly_customer_metrics(fact: DataFrame) -> DataFrame:
    """Per month (there is no customer key): distinct sales, revenue and
    the average line amount."""
    return (fact.groupBy(month_label("date").alias("month_year"))
            .agg(F.count_distinct("sale_id").alias("total_transactions"),
                 F.sum("line_amount").alias("monthly_revenue"), F.avg("line_amount").alias("avg_sale_amount")))


def _store_month(fact: DataFrame, dim_store: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per store label and month: partial sums and the distinct sales and days.

    The fact is reduced to (store, month, sale) and to (store, day), both on the map
    side first; distinct sales and days are then plain counts of nested groups,
    and store labels are joined to rows per store and month only.  Duplicate
    dimension rows add to the sums and not to the distinct counts, as in a join
    before grouping."""
    # dim_date: one row per day, bounded by the calendar -> broadcast
    dd = F.broadcast(dim_date.select("date_id", "year", "month"))
    dated = fact.join(dd, "date_id")
    month = ["store_id", "year", "month"]
    parts = [F.sum(c).alias(c) for c in ("_amt", "_qty", "_nl")]
    by_sale = (_pre(dated, [*month, "sale_id"])
               .groupBy(*month).agg(*parts, F.count("sale_id").alias("_sales")))
    by_day = dated.groupBy(*month, "date").agg(F.lit(1)).groupBy(*month).agg(F.count("date").alias("_days"))
    ds = dim_store.select("store_id", "store_name", "town")
    return (by_sale.join(by_day, month).join(ds, "store_id")
            .groupBy("store_id", "store_name", "town", "year", "month")
            .agg(F.sum("_amt").alias("monthly_revenue"), F.sum("_qty").alias("total_items_sold"),
                 F.max("_sales").alias("transaction_count"), _avg().alias("avg_transaction_value"),
                 F.max("_days").alias("trading_days")))


def create_store_performance_dashboard(fact: DataFrame, dim_store: DataFrame,
                                       dim_date: DataFrame) -> DataFrame:
    """Per store and month.  transaction_count counts distinct sales here."""
    return _store_month(fact, dim_store, dim_date).withColumn("month_year", month_of_parts("year", "month"))


def create_store_performance_avg_daily(fact: DataFrame, dim_store: DataFrame,
                                       dim_date: DataFrame) -> DataFrame:
    """G4 without month_year plus revenue per trading day, sorted by store
    name, year and month."""
    return (_store_month(fact, dim_store, dim_date)
            .withColumn("avg_daily_revenue", F.try_divide("monthly_revenue", "trading_days"))
            .orderBy("store_name", "year", "month"))


def trading_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame | None:
    """``_date``, the days of the fact, with ``_d_date``, ``year`` and ``month`` of their rows in
    dim_date, where G2 and G5 of ``fact`` group its rows alike: all rows of a day have one
    date_id, and no two rows found in dim_date make one group.  Else None.

    Counted now on a row per calendar day, kept in the scratch folder."""
    pairs = stored(fact.select(F.col("date").alias("_date"), "date_id").distinct(), "fact-days")
    found = pairs.join(dim_date.select("date_id", F.col("date").alias("_d_date"), "year", "month"), "date_id")
    of_days = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce(F.col("_date").cast("string"), F.lit(""))).alias("groups"))
    of_found = found.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct("_d_date", "year", "month")).alias("groups"))
    if any(r.n != r.groups for r in of_days.unionByName(of_found).collect()):
        return None
    return stored(found.select("_date", "_d_date", "year", "month"), "trading-dates")


def create_product_sales_trends(fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame, *,
                                parts: int | None = None, days: DataFrame | None = None,
                                daily: DataFrame | None = None, dates: DataFrame | None = None) -> DataFrame:
    """Per product and day, with the day's year and month.  ``days``: as for G2.

    With ``daily``, the rows of G2 of the same fact and products, and ``dates``, their
    :func:`trading_dates`, its sums are taken from there: the fact is not grouped again."""
    if daily is not None and dates is not None:
        return daily.join(F.broadcast(dates), F.col("date").eqNullSafe(F.col("_date"))).select(
            "product_id", "product_name", "category", "year", "month", F.col("_d_date").alias("date"),
            "daily_revenue", F.col("total_quantity_sold").alias("daily_quantity_sold"),
            F.col("times_sold").alias("times_sold_today"))
    # dim_date: one row per day, bounded by the calendar -> broadcast
    dd = F.broadcast(dim_date.select("date_id", F.col("date").alias("_d_date"), "year", "month"))
    dated = fact.select("product_id", "date_id", "line_amount", "quantity", "sale_id").join(dd, "date_id")
    pre = _by_product(dated, ["product_id", "year", "month", "_d_date"], "_d_date", parts, days)
    return _labelled(pre, dim_product, parts, days is not None).select(
        "product_id", "product_name", "category", "year", "month", F.col("_d_date").alias("date"),
        F.col("_amt").alias("daily_revenue"), F.col("_qty").alias("daily_quantity_sold"),
        F.col("_n").alias("times_sold_today"))
