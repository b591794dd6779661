"""Named queries over the test tables: each takes (spark, sf_dir) and returns
a DataFrame.  The retail tables come from :mod:`shelfline.sources.retail`;
the exact median is used so that results are comparable across engines.

Comparison rule for floating columns: sums of doubles are rounded to 2
places and averages to 6 (summation order differs between engines)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import operators as op
from ..config import CLEANED_TX, CURATED, RAW_REF, RAW_TX, SERVING
from ..functions.dates import day_window, in_window, month_range, to_day
from ..functions.quantile import approx_quantile, exact_quantile
from ..operators.skew import hot_keys, join_parts
from ..session import fresh_path
from ..sinks import parquet
from ..sinks.tables import SnapshotTable
from ..sources import retail
from ..sources.files import read_csv, read_parquet, read_version
from ..sources.layout import Lake
from . import jobs

ONE_DAY = "1998-03-16"
ONE_MONTH = "1998-03"
OLD_UNTIL = "1995-03-01"      # dimensions as upserted: sales from this day on, attributes changed
NEW_FROM = "2001-06-01"       # and as first published: sales before this day

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, r2=(), r6=()) -> DataFrame:
    cols = {c: F.round(c, 2) for c in r2} | {c: F.round(c, 6) for c in r6}
    return df.withColumns(cols) if cols else df


class Retail:
    """Cleaned and modelled retail tables of one test-data folder, each built
    when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, payments: DataFrame | None = None):
        self.inputs = retail.retail_inputs(spark, sf_dir)
        self.raw_payments = payments if payments is not None else self.inputs.payments

    @cached_property
    def hot(self) -> dict[str, DataFrame]:
        """Sales with many lines or payments, counted once on the raw tables."""
        return {"hot_lines": hot_keys(self.inputs.sales_details, "sale_id"),
                "hot_payments": hot_keys(self.raw_payments, "sale_id")}

    @cached_property
    def parts(self) -> int | None:
        return join_parts(self.inputs.sales_details)

    @cached_property
    def details(self) -> DataFrame:
        i = self.inputs
        return op.clean_sales_details(i.sales_details, i.products, i.sales, median_method="exact",
                                      hot_sales=self.hot["hot_lines"], parts=self.parts)

    @cached_property
    def sales(self) -> DataFrame:
        return op.clean_sales(self.inputs.sales, self.details)

    @cached_property
    def payments(self) -> DataFrame:
        return op.clean_payments(self.raw_payments, self.inputs.sales, hot_sales=self.hot["hot_payments"])

    @cached_property
    def enriched(self) -> DataFrame:
        return op.enrich_sales_with_stores(self.sales, self.inputs.stores)

    @cached_property
    def visited(self) -> DataFrame:
        """Sales with their stores; totals as they came (dimensions and the fact do not use them)."""
        return op.enrich_sales_with_stores(self.inputs.sales, self.inputs.stores)

    @cached_property
    def dim_product(self) -> DataFrame:
        return op.create_dim_product(self.details)

    @cached_property
    def dim_store(self) -> DataFrame:
        return op.create_dim_store(self.visited)

    @cached_property
    def dim_date(self) -> DataFrame:
        return op.create_dim_date(self.inputs.sales)

    @cached_property
    def fact(self) -> DataFrame:
        return op.create_fact_sales(self.inputs.sales, self.details, self.payments, self.dim_date, parts=self.parts, **self.hot)


def q_dedup(table: str, key: str, corrected: str) -> Query:
    def run(spark, sf_dir):
        feed = retail.replayed(getattr(retail, table)(spark, sf_dir), corrected)
        return op.dedup_by_key(feed, key)
    return run


def q_ingest_details_by_sale(spark, sf_dir):
    s = retail.sales(spark, sf_dir).select("sale_id", F.to_date("timestamp").alias("date"))
    return retail.sales_details(spark, sf_dir).join(s, "sale_id")


def q_ingest_payments_by_sale(spark, sf_dir):
    s = retail.sales(spark, sf_dir).select("sale_id", F.to_date("timestamp").alias("date"))
    return retail.payments(spark, sf_dir).join(s, "sale_id")


def q_ingest_increment(spark, sf_dir):
    lo, hi = day_window(ONE_DAY)
    sales = retail.sales(spark, sf_dir)
    inc = sales.where(in_window(sales, "timestamp", lo, hi))
    return retail.sales_details(spark, sf_dir).join(inc.select("sale_id", F.to_date("timestamp").alias("date")),
                                                    "sale_id")


def q_median_price(spark, sf_dir):
    positive = retail.sales_details(spark, sf_dir).where(F.col("unit_price") > 0)
    m = exact_quantile(positive, "unit_price", 0.5)
    p = F.col("unit_price")
    return positive.agg(F.min(F.when(p >= F.lit(m), p)).alias("median_price"),
                        F.count(p).alias("positive_count"),
                        F.count(F.when(p <= F.lit(m), p)).alias("at_or_below"))


def q_median_price_approx(spark, sf_dir):
    """A3: the approximate median's rank error stays within its bound."""
    positive = retail.sales_details(spark, sf_dir).where(F.col("unit_price") > 0)
    p, m = F.col("unit_price"), approx_quantile(positive, "unit_price")
    share = F.count(F.when(p <= F.col("m"), 1)) / F.count("*")
    below = F.count(F.when(p < F.col("m"), 1)) / F.count("*")
    return positive.withColumn("m", m).agg(F.count("*").alias("positive_count"),
                                           ((share >= 0.45) & (below <= 0.55)).alias("within_error"))


def q_clean_sales_details(spark, sf_dir):
    return Retail(spark, sf_dir).details


def q_clean_sales(spark, sf_dir):
    return _round(Retail(spark, sf_dir).sales, r2=["total_amount"])


def q_clean_payments(spark, sf_dir):
    return Retail(spark, sf_dir).payments


def q_enrich_sales(spark, sf_dir):
    return _round(Retail(spark, sf_dir).enriched, r2=["total_amount"])


def q_dim_product(spark, sf_dir):
    return Retail(spark, sf_dir).dim_product


def q_dim_store(spark, sf_dir):
    return Retail(spark, sf_dir).dim_store


def q_dim_date(spark, sf_dir):
    return Retail(spark, sf_dir).dim_date


def q_fact_sales(spark, sf_dir):
    return Retail(spark, sf_dir).fact


def q_fact_sales_two_payments(spark, sf_dir):
    pay = retail.with_second_payment(retail.payments(spark, sf_dir), 19)
    return Retail(spark, sf_dir, payments=pay).fact


G1_R = dict(r2=["daily_sales"], r6=["avg_transaction_value"])
G4_R = dict(r2=["monthly_revenue"], r6=["avg_transaction_value"])


def q_daily_store_sales(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return _round(op.create_daily_store_sales(r.fact, r.dim_store), **G1_R)


def q_daily_product_sales(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return _round(op.create_daily_product_sales(r.fact, r.dim_product, parts=r.parts), r2=["daily_revenue"])


def q_monthly_customer_metrics(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return _round(op.create_monthly_customer_metrics(r.fact), r2=["monthly_revenue"], r6=["avg_sale_amount"])


def q_store_performance(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return _round(op.create_store_performance_dashboard(r.fact, r.dim_store, r.dim_date), **G4_R)


def q_product_sales_trends(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return _round(op.create_product_sales_trends(r.fact, r.dim_product, r.dim_date, parts=r.parts), r2=["daily_revenue"])


def q_daily_store_sales_one_day(spark, sf_dir):
    r = Retail(spark, sf_dir)
    fact = r.fact.where(F.col("date") == F.lit(to_day(ONE_DAY)))
    return _round(op.create_daily_store_sales(fact, r.dim_store), **G1_R)


def q_store_performance_one_month(spark, sf_dir):
    r = Retail(spark, sf_dir)
    lo, hi = month_range(ONE_MONTH)
    fact = r.fact.where((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))
    return _round(op.create_store_performance_dashboard(fact, r.dim_store, r.dim_date), **G4_R)


def q_dim_payment_method(spark, sf_dir):
    return op.create_dim_payment_method(retail.payments(spark, sf_dir))


def q_dim_payment_method_new(spark, sf_dir):
    pay = retail.payments(spark, sf_dir)
    existing = op.create_dim_payment_method(pay.where(F.col("method") == "Cash"))
    return op.create_dim_payment_method(pay, existing)


def q_fact_sales_method_id(spark, sf_dir):
    r = Retail(spark, sf_dir)
    dpm = op.create_dim_payment_method(r.payments)
    return op.create_fact_sales_with_method_id(r.visited, r.details, r.payments, r.dim_date, dpm, parts=r.parts, **r.hot)


def q_store_performance_avg_daily(spark, sf_dir):
    """E3 + O1: position is the row's place in the sorted output."""
    r = Retail(spark, sf_dir)
    out = op.create_store_performance_avg_daily(r.fact, r.dim_store, r.dim_date)
    placed = out.withColumn("position", F.monotonically_increasing_id()).withColumn(
        "position", F.row_number().over(Window.orderBy("position")).cast("long"))
    return _round(placed, r2=["monthly_revenue"], r6=["avg_transaction_value", "avg_daily_revenue"])


def _old_and_new(df: DataFrame, changed: str) -> tuple[DataFrame, DataFrame]:
    """Rows before NEW_FROM as they are; rows from OLD_UNTIL on with ``changed``
    in capitals.  Every sale is in one at least; some keys are in both, some in either."""
    old = df.where(F.col("date") < F.lit(to_day(NEW_FROM)))
    new = df.where(F.col("date") >= F.lit(to_day(OLD_UNTIL)))
    return old, new.withColumn(changed, F.upper(changed))


def q_upsert_dim_product(spark, sf_dir):
    old, new = _old_and_new(Retail(spark, sf_dir).details, "description")
    return op.upsert(op.create_dim_product(old), op.create_dim_product(new), "product_id")


def q_upsert_dim_store(spark, sf_dir):
    dated = Retail(spark, sf_dir).visited.withColumn("date", F.to_date("timestamp"))
    old, new = _old_and_new(dated, "town")
    return op.upsert(op.create_dim_store(old), op.create_dim_store(new), "store_id")


def q_upsert_dim_date(spark, sf_dir):
    sales = Retail(spark, sf_dir).inputs.sales
    d = F.to_date("timestamp")
    old = op.create_dim_date(sales.where(d < F.lit(to_day(NEW_FROM))))
    # the published quarter was wrong; the new run brings the right one
    old = old.withColumn("quarter", F.lit(0))
    new = op.create_dim_date(sales.where(d >= F.lit(to_day(OLD_UNTIL))))
    return op.upsert(old, new, "date_id")


def q_audit_counts(spark, sf_dir):
    return op.audit_counts(Retail(spark, sf_dir).fact)


QUERIES: dict[str, Query] = {
    "dedup_sales": q_dedup("sales", "sale_id", "total_amount"),
    "dedup_details": q_dedup("sales_details", "detail_id", "quantity"),
    "dedup_payments": q_dedup("payments", "payment_id", "amount"),
    "ingest_details_by_sale": q_ingest_details_by_sale,
    "ingest_payments_by_sale": q_ingest_payments_by_sale,
    "ingest_increment": q_ingest_increment,
    "median_price": q_median_price,
    "median_price_approx": q_median_price_approx,
    "clean_sales_details": q_clean_sales_details,
    "clean_sales": q_clean_sales,
    "clean_payments": q_clean_payments,
    "enrich_sales": q_enrich_sales,
    "dim_product": q_dim_product,
    "dim_store": q_dim_store,
    "dim_date": q_dim_date,
    "fact_sales": q_fact_sales,
    "fact_sales_two_payments": q_fact_sales_two_payments,
    "daily_store_sales": q_daily_store_sales,
    "daily_product_sales": q_daily_product_sales,
    "monthly_customer_metrics": q_monthly_customer_metrics,
    "store_performance": q_store_performance,
    "product_sales_trends": q_product_sales_trends,
    "daily_store_sales_one_day": q_daily_store_sales_one_day,
    "store_performance_one_month": q_store_performance_one_month,
    "dim_payment_method": q_dim_payment_method,
    "dim_payment_method_new": q_dim_payment_method_new,
    "fact_sales_method_id": q_fact_sales_method_id,
    "store_performance_avg_daily": q_store_performance_avg_daily,
    "upsert_dim_product": q_upsert_dim_product,
    "upsert_dim_store": q_upsert_dim_store,
    "upsert_dim_date": q_upsert_dim_date,
    "audit_counts": q_audit_counts,
}


# ------------------------------------------------------------ job queries --
# Each runs the real jobs, by ``jobs.run``, and writes the layer that it is about into a
# lake of its own below the session's scratch folder.  The layers before it are
# those that the first job query of the session made from the same tables.
# Queries of daily and monthly jobs first spoil what the job must mend, so a
# job that does nothing gives other rows.

REF_VERSION = "2025-07"
# stage and parameters that make a layer, and the layers that it writes
_STAGES = {"ingest": ("ingestion", (RAW_TX, RAW_REF)), "transform": ("transformation", (CLEANED_TX,)),
           "model": ("modeling", (CURATED,)), "aggregate": ("aggregation", (SERVING,))}
#: Lakes made in this process: (application, folder, stage) -> root of its layers.
_MADE: dict[tuple[str, str, str], str] = {}


def _sources(sf_dir: str) -> jobs.Sources:
    t = retail.TestTableSource(sf_dir)
    return jobs.Sources(transactions=t, products=t.products, stores=t.stores)


def _full(spark: SparkSession, sf_dir: str, lake: Lake, step: str) -> None:
    params = {"ingest": {"src": _sources(sf_dir), "version": REF_VERSION}, "transform": {"median_method": "exact"}}
    jobs.run(_STAGES[step][0], "full", spark, lake, **params.get(step, {}))


def _lake(spark: SparkSession, sf_dir: str, upto: str, keep: bool = False) -> Lake:
    """A lake whose ``upto`` layer is its own, just made by the full job; earlier
    layers are shared and only read.  With ``keep`` the caller only reads the
    own layer too, so that later queries may share it."""
    before = list(_STAGES)[: list(_STAGES).index(upto)]
    shared: list[tuple[tuple[str, str], str]] = []
    for step in before:
        key = (spark.sparkContext.applicationId, sf_dir, step)
        if key not in _MADE:
            lake = Lake(fresh_path(spark, f"lake-{step}"), elsewhere=tuple(shared))
            _full(spark, sf_dir, lake, step)
            _MADE[key] = lake.root
        shared += [(layer, _MADE[key]) for layer in _STAGES[step][1]]
    lake = Lake(fresh_path(spark, "lake"), elsewhere=tuple(shared))
    _full(spark, sf_dir, lake, upto)
    if keep:
        _MADE.setdefault((spark.sparkContext.applicationId, sf_dir, upto), lake.root)
    return lake


#: Capped prices make sums that end in half a cent; sums of sums differ in the last bits,
#: so both sides add this before they round to cents.
OFF_TIES = 0.0002


def _totals(tables: dict[str, tuple[DataFrame, str, str]], by: str | None = None) -> DataFrame:
    """table_name, (by,) row_count, key_sum and amount of each (table, key, amount expression)."""
    keys = [by] if by else []
    return reduce(DataFrame.unionByName, [
        df.groupBy(*keys).agg(F.count("*").alias("row_count"), F.sum(F.col(key).cast("long")).alias("key_sum"),
                              F.round(F.sum(F.expr(amount).cast("double")) + OFF_TIES, 2).alias("amount"))
        .withColumn("table_name", F.lit(name)) for name, (df, key, amount) in tables.items()])


RAW_AMOUNTS = {"sales": ("sale_id", "total_amount"), "sales_details": ("sale_id", "quantity * unit_price"),
               "payments": ("payment_id", "amount")}
CLEANED_AMOUNTS = {"sales": ("sale_id", "total_amount"), "sales_details": ("sale_id", "quantity * unit_price + VAT"),
                   "payments": ("payment_id", "CASE WHEN method = 'Card' THEN amount ELSE 0 END")}
CURATED_AMOUNTS = {"dim_product": ("product_id", "length(product_name) + length(category)"),
                   "dim_store": ("store_id", "number_of_employees"),
                   "dim_date": ("date_id", "quarter"), "fact_sales": ("sale_id", "line_amount + VAT")}
SERVING_AMOUNTS = {"daily_store_sales": ("store_id", "daily_sales"), "daily_product_sales": ("product_id", "daily_revenue"),
                   "product_sales_trends": ("product_id", "daily_revenue"),
                   "monthly_customer_metrics": ("total_transactions", "monthly_revenue"),
                   "store_performance": ("transaction_count", "monthly_revenue")}


def _raw(spark, lake) -> dict:
    return {t: (read_parquet(spark, lake.table(RAW_TX, t)), *a) for t, a in RAW_AMOUNTS.items()}


def _cleaned(spark, lake) -> dict:
    return {t: (read_parquet(spark, lake.table(CLEANED_TX, t)), *a) for t, a in CLEANED_AMOUNTS.items()}


def _managed(spark, lake, where, amounts) -> dict:
    return {t: (jobs.table(spark, lake, where, t).read(), *a) for t, a in amounts.items()}


def q_ingest_full(spark, sf_dir):
    """L1: totals of the three raw tables and the two reference snapshots."""
    lake = _lake(spark, sf_dir, "ingest", keep=True)
    reference = {"products": ("product_id", "unit_price"), "stores": ("store_id", "number_of_employees")}
    return _totals(_raw(spark, lake) | {
        t: (read_version(spark, lake.table(RAW_REF, t), REF_VERSION), *a) for t, a in reference.items()})


def q_transform_full(spark, sf_dir):
    return _totals(_cleaned(spark, _lake(spark, sf_dir, "transform", keep=True)))


def q_model_full(spark, sf_dir):
    return _totals(_managed(spark, _lake(spark, sf_dir, "model", keep=True), CURATED, CURATED_AMOUNTS))


def q_aggregate_full(spark, sf_dir):
    return _totals(_managed(spark, _lake(spark, sf_dir, "aggregate", keep=True), SERVING, SERVING_AMOUNTS))


def q_ingest_daily(spark, sf_dir):
    """The day's increment ingested twice: the rerun replaces, never duplicates."""
    lake = Lake(fresh_path(spark, "lake-daily"))
    for _ in range(2):
        jobs.run("ingestion", "Daily", spark, lake, src=_sources(sf_dir), day=ONE_DAY)
    return read_parquet(spark, lake.table(RAW_TX, "sales_details"))


class _ChangedSource:
    """The source on a later day: the sales of ONE_DAY cost one more and have no
    payments by card, and lines of sales before OLD_UNTIL are gone."""

    def __init__(self, source: retail.TestTableSource):
        self.source = source

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        df = self.source(spark, table)
        if table == "sales":
            own = F.to_date("timestamp") == F.lit(to_day(ONE_DAY))
            return df.withColumn("total_amount", F.col("total_amount") + F.when(own, 1.0).otherwise(0.0))
        days = self.source(spark, "sales").select("sale_id", F.to_date("timestamp").alias("_day"))
        joined = df.join(days, "sale_id", "left")
        if table == "payments":
            gone = (F.col("_day") == F.lit(to_day(ONE_DAY))) & (F.col("method") == "Card")
        else:
            gone = F.col("_day") < F.lit(to_day(OLD_UNTIL))
        return joined.where(~F.coalesce(gone, F.lit(False))).drop("_day")


def q_ingest_daily_on_history(spark, sf_dir):
    """L2 on a lake that holds the history: one changed day is ingested, all
    other days keep their rows.  Totals of the raw tables by date."""
    lake = _lake(spark, sf_dir, "ingest")
    t = retail.TestTableSource(sf_dir)
    jobs.run("ingestion", "daily", spark, lake, src=jobs.Sources(_ChangedSource(t), t.products, t.stores), day=ONE_DAY)
    return _totals(_raw(spark, lake), "date")


def _clear(spark, path: str, column: str, value) -> None:
    """Takes the rows of one partition away."""
    df = read_parquet(spark, path)
    parquet.replace_partitions(df.where("false"), path, column, [value])


def q_transform_daily(spark, sf_dir):
    """L5 on a lake whose cleaned day is missing; the full run's cap.  Totals of
    the cleaned tables by date."""
    lake = _lake(spark, sf_dir, "transform")
    for t in CLEANED_AMOUNTS:
        _clear(spark, lake.table(CLEANED_TX, t), "date", to_day(ONE_DAY))
    lines = op.dedup_by_key(read_parquet(spark, lake.table(RAW_TX, "sales_details")), "detail_id")
    cap = op.clean.price_cap(lines, median_method="exact")
    jobs.run("transformation", "daily", spark, lake, day=ONE_DAY, cap=cap)
    return _totals(_cleaned(spark, lake), "date")


def _spoil_model(spark, lake: Lake) -> None:
    """The fact loses ONE_DAY; product categories and store towns are out of date."""
    fact = jobs.table(spark, lake, CURATED, "fact_sales")
    fact.replace_partitions(fact.read().where("false"), "date", [to_day(ONE_DAY)])
    for name, column in (("dim_product", "category"), ("dim_store", "town")):
        t = jobs.table(spark, lake, CURATED, name)
        t.overwrite(t.read().withColumn(column, F.lit("stale")))


def q_model_daily(spark, sf_dir):
    """L7 on a lake whose fact lacks the day: totals of the fact by date."""
    lake = _lake(spark, sf_dir, "model")
    _spoil_model(spark, lake)
    jobs.run("modeling", "daily", spark, lake, day=ONE_DAY)
    fact = {"fact_sales": CURATED_AMOUNTS["fact_sales"]}
    return _totals(_managed(spark, lake, CURATED, fact), "date")


def q_model_daily_dimensions(spark, sf_dir):
    """Products and stores of the day get their attributes back, all
    others stay as they were published."""
    lake = _lake(spark, sf_dir, "model")
    _spoil_model(spark, lake)
    jobs.run("modeling", "daily", spark, lake, day=ONE_DAY)
    product = jobs.table(spark, lake, CURATED, "dim_product").read().select(
        F.lit("dim_product").alias("table_name"), F.col("product_id").cast("long").alias("id"), F.col("category").alias("attribute"))
    store = jobs.table(spark, lake, CURATED, "dim_store").read().select(
        F.lit("dim_store").alias("table_name"), F.col("store_id").cast("long").alias("id"), F.col("town").alias("attribute"))
    return product.unionByName(store)


def q_aggregate_daily(spark, sf_dir):
    """L9 on a lake whose daily tables lack the day: their totals by date."""
    lake = _lake(spark, sf_dir, "aggregate")
    daily = {t: SERVING_AMOUNTS[t] for t in jobs.DAILY_AGGS}
    for t in daily:
        own = jobs.table(spark, lake, SERVING, t)
        own.replace_partitions(own.read().where("false"), "date", [to_day(ONE_DAY)])
    jobs.run("aggregation", "daily", spark, lake, day=ONE_DAY)
    return _totals(_managed(spark, lake, SERVING, daily), "date")


def q_aggregate_monthly(spark, sf_dir):
    """L10 on a lake whose monthly tables lack the month: their totals by month."""
    lake = _lake(spark, sf_dir, "aggregate")
    monthly = {t: SERVING_AMOUNTS[t] for t in jobs.MONTHLY_AGGS}
    for t in monthly:
        own = jobs.table(spark, lake, SERVING, t)
        own.replace_partitions(own.read().where("false"), "month_year", [ONE_MONTH])
    jobs.run("aggregation", "Monthly", spark, lake, month=ONE_MONTH)
    return _totals(_managed(spark, lake, SERVING, monthly), "month_year")


def q_replace_day(spark, sf_dir):
    """A corrected feed for one day (its card payments only) replaces
    that day's partition; all other days are untouched."""
    fact = Retail(spark, sf_dir).fact
    p = fresh_path(spark, "replace-day")
    parquet.write_partitioned(fact, p, "date")
    day = fact.where((F.col("date") == F.lit(to_day(ONE_DAY))) & (F.col("payment_method") == "Card"))
    parquet.replace_partitions(day, p, "date", [to_day(ONE_DAY)])
    return read_parquet(spark, p)


def q_replace_empty_day(spark, sf_dir):
    """A day whose rows are gone at the source loses its old rows."""
    fact = Retail(spark, sf_dir).fact
    p = fresh_path(spark, "replace-empty-day")
    parquet.write_partitioned(fact, p, "date")
    parquet.replace_partitions(fact.where("false"), p, "date", [to_day(ONE_DAY)])
    return read_parquet(spark, p)


def q_replace_month(spark, sf_dir):
    """The month's dashboard rows are replaced (from card payments only);
    the other months are kept."""
    r = Retail(spark, sf_dir)
    t = SnapshotTable(spark, fresh_path(spark, "replace-month"))
    t.overwrite(op.create_store_performance_dashboard(r.fact, r.dim_store, r.dim_date), "month_year")
    lo, hi = month_range(ONE_MONTH)
    month = r.fact.where((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi))
                         & (F.col("payment_method") == "Card"))
    t.replace_partitions(op.create_store_performance_dashboard(month, r.dim_store, r.dim_date), "month_year", [ONE_MONTH])
    return _round(t.read(), **G4_R)


def q_append_day(spark, sf_dir):
    """The fact without one day, then that day appended."""
    fact = Retail(spark, sf_dir).fact
    t = SnapshotTable(spark, fresh_path(spark, "append-day"))
    d = F.col("date") == F.lit(to_day(ONE_DAY))
    t.overwrite(fact.where(~d), "date")
    t.append(fact.where(d), "date")
    return t.read()


def _two_snapshots(spark, sf_dir):
    old, new = _old_and_new(Retail(spark, sf_dir).details, "description")
    t = SnapshotTable(spark, fresh_path(spark, "dim-product"))
    t.overwrite(op.create_dim_product(old))
    t.merge(op.create_dim_product(new), "product_id")
    return t


def q_snapshot_as_of_version(spark, sf_dir):
    """The dimension as first published (version 0), after a later merge."""
    return _two_snapshots(spark, sf_dir).read(version=0)


def q_snapshot_as_of_time(spark, sf_dir):
    """The dimension as of the first publish time."""
    t = _two_snapshots(spark, sf_dir)
    return t.read(timestamp=t.history()[0].published_at)


def q_snapshot_latest(spark, sf_dir):
    """Latest snapshot after the merge (= the upsert result)."""
    return _two_snapshots(spark, sf_dir).read()


def q_parquet_roundtrip(spark, sf_dir):
    """W1 + R4: cleaned payments written by date and read back."""
    p = fresh_path(spark, "payments")
    parquet.write_partitioned(Retail(spark, sf_dir).payments, p, "date")
    return read_parquet(spark, p)


def _products_csv(spark, sf_dir) -> tuple[str, DataFrame]:
    products = retail.products(spark, sf_dir)
    path = fresh_path(spark, "products-csv")
    products.write.option("header", True).csv(path)
    return path, products


def q_csv_reference(spark, sf_dir):
    """R1 + W4 + W4o: the products reference delivered as a CSV file, read with a
    declared schema into versioned snapshots.  An older snapshot with other
    prices exists, and the newest one is first written wrong and overwritten;
    the newest is read back (R4v)."""
    path, products = _products_csv(spark, sf_dir)
    root = fresh_path(spark, "reference-products")
    read = read_csv(spark, path, products.schema)
    parquet.write_once(read.withColumn("unit_price", F.lit(0.0)), f"{root}/version=2025-06")
    parquet.write_once(read.where("false"), f"{root}/version={REF_VERSION}")
    parquet.overwrite(read, f"{root}/version={REF_VERSION}")
    return read_version(spark, root)


def q_ingest_reference(spark, sf_dir):
    """L3 + R1 + W4 + A10: monthly reference snapshot from CSV files, written once, counted back."""
    from ..sources.factory import make_sources
    path, products = _products_csv(spark, sf_dir)
    stores = retail.stores(spark, sf_dir)
    stores_path = fresh_path(spark, "stores-csv")
    stores.write.option("header", True).csv(stores_path)
    src = make_sources(retail.TestTableSource(sf_dir), path, stores_path,
                       products_schema=products.schema, stores_schema=stores.schema)
    return jobs.run("ingestion", "monthly", spark, Lake(fresh_path(spark, "lake-reference")), src=src, version=REF_VERSION)


QUERIES.update({
    "ingest_reference": q_ingest_reference,
    "ingest_full": q_ingest_full,
    "ingest_daily": q_ingest_daily,
    "ingest_daily_on_history": q_ingest_daily_on_history,
    "transform_full": q_transform_full,
    "transform_daily": q_transform_daily,
    "model_full": q_model_full,
    "model_daily": q_model_daily,
    "model_daily_dimensions": q_model_daily_dimensions,
    "aggregate_full": q_aggregate_full,
    "aggregate_daily": q_aggregate_daily,
    "aggregate_monthly": q_aggregate_monthly,
    "replace_day": q_replace_day,
    "replace_empty_day": q_replace_empty_day,
    "replace_month": q_replace_month,
    "append_day": q_append_day,
    "snapshot_as_of_version": q_snapshot_as_of_version,
    "snapshot_as_of_time": q_snapshot_as_of_time,
    "snapshot_latest": q_snapshot_latest,
    "parquet_roundtrip": q_parquet_roundtrip,
    "csv_reference": q_csv_reference,
})
