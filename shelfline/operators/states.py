"""Daily states that answer monthly and whole-history questions without reading the
fact or the lines again.  A state is kept by day, so a changed day replaces its own
rows only.

Sales states (A8, G3, G4, L10): by day and store, partial sums and the distinct
sales as exact bitmaps.  A bitmap is one long of 64 neighbouring ids; its row appears
for every (day, store, id range) that occurs, so a state never has more rows than
sales, also where ids do not grow with time.

Price states (A3, C1, L5): by day, a KLL sketch of the positive prices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import month_label, month_of_parts

#: Size parameter of the price sketches: the rank error of one is about 0.5 %.
SKETCH_K = 600
#: Neighbouring sale ids that share a bitmap: the bits of a long.
RANGE_BITS = 6


def sales_states(fact: DataFrame) -> DataFrame:
    """date, store_id, id_range, sales (bitmap), and the sums of the fact rows of these
    sales.  Sums of a day and store are spread over its id ranges.  Rows without
    sale_id have the range null and no bitmap bits; sale_id must be a whole number.

    A long is updated in place by a hash aggregate; a binary bitmap would be sorted
    and copied at its full length for each group, however few ids the group has."""
    sale = F.col("sale_id").cast("long")
    bit = F.expr(f"shiftleft(1L, CAST(CAST(sale_id AS LONG) & {(1 << RANGE_BITS) - 1} AS INT))")
    return fact.groupBy("date", "store_id", F.shiftright(sale, RANGE_BITS).alias("id_range")).agg(
        F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias("sales"),
        F.sum("line_amount").alias("amount"), F.sum("quantity").alias("quantity"),
        F.count("line_amount").alias("amounts"))


def _merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and distinct sales per ``keys``: bitmaps of one id range are united, then
    their bits are counted.  Two group-bys of numbers; both reduce before they shuffle."""
    by_range = states.groupBy(*keys, "id_range").agg(
        F.bit_count(F.bit_or("sales")).cast("long").alias("distinct_sales"),
        *(F.sum(c).alias(c) for c in ("amount", "quantity", "amounts")))
    return by_range.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("distinct_sales", "amount", "quantity", "amounts")))


def monthly_metrics(states: DataFrame) -> DataFrame:
    """G3 from the daily states."""
    by_month = _merged(states.withColumn("month_year", month_label("date")), ["month_year"])
    return by_month.select("month_year", F.col("distinct_sales").alias("total_transactions"), F.col("amount").alias("monthly_revenue"),
                           F.try_divide("amount", "amounts").alias("avg_sale_amount"))


def store_dashboard(states: DataFrame, dim_store: DataFrame) -> DataFrame:
    """G4 from the daily states: also the distinct trading days, which are rows of the
    states.  Duplicate store rows add to sums and not to distinct counts, as in G4."""
    keys = ["store_id", "year", "month"]
    own = states.withColumns({"year": F.year("date"), "month": F.month("date")})
    days = own.groupBy(*keys, "date").agg(F.lit(1)).groupBy(*keys).agg(F.count("date").alias("days"))
    labels = dim_store.select("store_id", "store_name", "town")
    return (_merged(own, keys).join(days, keys).join(labels, "store_id")
            .groupBy("store_id", "store_name", "town", "year", "month")
            .agg(F.sum("amount").alias("monthly_revenue"), F.sum("quantity").alias("total_items_sold"),
                 F.max("distinct_sales").alias("transaction_count"),
                 F.try_divide(F.sum("amount"), F.sum("amounts")).alias("avg_transaction_value"),
                 F.max("days").alias("trading_days"))
            .withColumn("month_year", month_of_parts("year", "month")))


def price_states(lines: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """date, prices (sketch) and n of the positive prices of each day of raw lines."""
    price = F.col("unit_price").cast("double")
    return lines.where(price > 0).groupBy("date").agg(
        F.kll_sketch_agg_double(price, F.lit(k)).alias("prices"), F.count(price).alias("n"))


def history_median(states: DataFrame, k: int = SKETCH_K) -> float | None:
    """The median price over all states; None without any.  The merged sketch has the
    rank error of one sketch, whatever the number of days.  Sketches are randomised,
    so the value is taken once, as a number, for all that it decides."""
    merged = states.agg(F.kll_merge_agg_double("prices", F.lit(k)).alias("prices"), F.count(F.lit(1)).alias("days"))
    return merged.select(F.when(F.col("days") > 0, F.kll_sketch_get_quantile_double("prices", F.lit(0.5)))).first()[0]


def history_cap(states: DataFrame, cap_factor: float = config.CAP_FACTOR) -> Column:
    """The price cap of C1 by the whole history's median, without reading its lines (null,
    so no cap, without any); pass it as ``cap`` to the daily transformation."""
    median = history_median(states)
    return F.lit(None if median is None else median * float(cap_factor)).cast("double")
