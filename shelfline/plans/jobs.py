"""The four jobs of the lake and their modes.

Each job reads its layer, calls the operators and publishes; outputs are
written tables, so every job cuts lineage and can be rerun after a failure.
Daily and monthly modes replace exactly the partitions they compute, so a
rerun leaves the table unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .. import operators as op
from ..config import CLEANED_TX, CURATED, RAW_KEYS, RAW_REF, RAW_REJECTED, RAW_TX, SERVING
from ..functions.dates import day_window, in_window, month_range, sale_date, to_day
from ..operators import dedup
from ..operators.dealing import balanced
from ..operators.digests import changed_days, day_digests
from ..operators.skew import broadcast_if_few, day_parts, join_parts
from ..sinks import parquet
from ..sinks.keyindex import KeyIndex
from ..session import stored
from ..sinks.tables import FormatTable, SnapshotTable, open_table
from ..sources.files import CheckedCsv, read_parquet, read_partition, read_version, read_version_as_of
from ..sources.layout import Lake

TX_KEYS = {"sales": "sale_id", "sales_details": "detail_id", "payments": "payment_id"}
DIMS = {"dim_product": "product_id", "dim_store": "store_id", "dim_date": "date_id"}
DAILY_AGGS = ("daily_store_sales", "daily_product_sales", "product_sales_trends")
MONTHLY_AGGS = ("monthly_customer_metrics", "store_performance")


@dataclass(frozen=True)
class Sources:
    """Where the jobs read from.  ``transactions(spark, table)`` returns
    sales / sales_details / payments (a JDBC source, or any DataFrame
    provider); ``products`` and ``stores`` return the reference tables, as a
    DataFrame or, with the lines that did not parse, as a ``CheckedCsv``."""
    transactions: Callable[[SparkSession, str], DataFrame]
    products: Callable[[SparkSession], DataFrame | CheckedCsv]
    stores: Callable[[SparkSession], DataFrame | CheckedCsv]


# ---------------------------------------------------------------- ingestion --
def _ingest(spark, lake: Lake, src: Sources, sales: DataFrame, write, *, narrow: bool = False,
            index: KeyIndex | None = None) -> None:
    """Lines and payments of ``sales`` (J1, J2), then the sales themselves, so
    that whoever sees a sale in raw sees its lines and payments.

    The sales are read from the source once and kept in the scratch folder.
    With ``narrow`` their sale_id range is pushed to the reads of the children
    (the join still decides).  With ``index`` sales that came on another day
    before are left out, lines and payments with them.  ``write`` gets the rows, the path
    and a table of about as many rows."""
    own = stored(sales.withColumn("date", sale_date("timestamp")), "ingest-sales")
    if index is not None:
        own = stored(index.unseen(own), "ingest-unseen")
    keys = own.select("sale_id", "date")
    span = own.agg(F.min("sale_id"), F.max("sale_id")).first() if narrow else None
    for t in ("sales_details", "payments"):
        child = src.transactions(spark, t)
        if narrow:
            kind = child.schema["sale_id"].dataType
            lo, hi = (F.lit(x).cast(kind) for x in span)
            child = child.where((F.col("sale_id") >= lo) & (F.col("sale_id") <= hi))
        write(child.join(keys, "sale_id"), lake.table(RAW_TX, t), child)
    write(own, lake.table(RAW_TX, "sales"), own)
    if index is not None:
        index.add(own)


def sale_index(spark: SparkSession, lake: Lake) -> KeyIndex:
    """The lake's index of ingested sales (integer sale_id)."""
    return KeyIndex(spark, lake.table(RAW_KEYS, "sales"), "sale_id")


def _kept(reference: DataFrame | CheckedCsv, lake: Lake, name: str, version: str) -> DataFrame:
    """The rows to publish.  The rejected ones of a checked file are written beside them
    first (replaced by a rerun), so whoever sees the snapshot finds them."""
    if isinstance(reference, DataFrame):
        return reference
    parquet.overwrite(reference.rejected, lake.table(RAW_REJECTED, name, version))
    return reference.kept


def ingest_full(spark: SparkSession, lake: Lake, src: Sources, *, version: str) -> None:
    """L1: whole transactional tables -> raw, partitioned by sale date;
    reference tables -> snapshot ``version`` (overwritten)."""
    _ingest(spark, lake, src, src.transactions(spark, "sales"),
            lambda df, p, like: parquet.write_partitioned(df, p, "date", rows=like.count()))
    for name, read in (("products", src.products), ("stores", src.stores)):
        parquet.overwrite(_kept(read(spark), lake, name, version), lake.table(RAW_REF, name, version))


def ingest_daily(spark: SparkSession, lake: Lake, src: Sources, *, day, mode: str = "replace",
                 unique: bool = False) -> None:
    """L2: the sales of ``day`` (half-open [day, day+1), pushed to the source)
    and their lines and payments; no other day of raw is read or written.
    ``replace`` (default) makes reruns safe, and a day without rows at the source
    is cleared; ``append`` adds rows like the original (rely on dedup downstream).
    With ``unique`` a sale that the lake's sale index has from another day is a
    replay and is left out; the day's sales are then added to the index (for a
    lake with history, first add that: ``sale_index(spark, lake).add(sales)``)."""
    lo, hi = day_window(day)
    s = src.transactions(spark, "sales")
    if mode == "replace":
        write = lambda df, p, _: parquet.replace_partitions(df, p, "date", [to_day(day)])
    elif mode == "append":
        write = lambda df, p, _: parquet.write_partitioned(df, p, "date", mode="append")
    else:
        raise ValueError("mode must be 'replace' or 'append'")
    _ingest(spark, lake, src, s.where(in_window(s, "timestamp", lo, hi)), write, narrow=True,
            index=sale_index(spark, lake) if unique else None)


def ingest_reference(spark: SparkSession, lake: Lake, src: Sources, *, version: str) -> DataFrame:
    """L3: write-once reference snapshot ``version``; returns the row counts, metrics
    of the writes (A10)."""
    out = []
    for name, read in (("products", src.products), ("stores", src.stores)):
        audit, path = op.WriteAudit(None), lake.table(RAW_REF, name, version)
        if parquet.has_files(spark, path):  # before rejected rows are replaced
            raise FileExistsError(f"{path} is written once")
        parquet.write_once(_kept(read(spark), lake, name, version), path, audit)
        out.append((name, audit.values["row_count"]))
    return spark.createDataFrame(out, "table_name string, row_count long")


# ----------------------------------------------------------- transformation --
@dataclass(frozen=True)
class _Rows:
    """Rows of a layer: those read from their date folders, and others dealt otherwise."""
    placed: DataFrame | None
    others: DataFrame | None = None

    @property
    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [df for df in (self.placed, self.others) if df is not None])

    def each(self, step: Callable[[DataFrame], DataFrame]) -> _Rows:
        return _Rows(*(df if df is None else step(df) for df in (self.placed, self.others)))

    def by_date(self, like: DataFrame | None = None) -> DataFrame:
        """All rows, lying by date: only the others are shuffled for it.  ``like``: a table of
        about as many rows or more."""
        if self.others is None:
            return self.placed
        return _Rows(self.placed, balanced(self.others, ["date"], None if like is None else like.count())).all


def _joined(*pieces: _Rows) -> _Rows:
    of = lambda side: [getattr(p, side) for p in pieces if getattr(p, side) is not None]
    return _Rows(*(reduce(DataFrame.unionByName, of(side)) if of(side) else None for side in ("placed", "others")))


def _deduplicated(spark, lake: Lake, where: tuple[str, str], day=None) -> dict[str, DataFrame]:
    return {t: rows.all for t, rows in _layer(spark, lake, where, day).items()}


def _layer(spark, lake: Lake, where: tuple[str, str], day=None) -> dict[str, _Rows]:
    """The transactional tables of a layer, deduplicated on their keys.

    Hashes of the keys tell which come more than once.  Where these are few, only their
    rows are deduplicated, once, into the scratch folder; all others are read where they
    are, without a shuffle, a sort or a copy.  Where they are many, all rows are."""
    out = {}
    for t, k in TX_KEYS.items():
        p = lake.table(where, t)
        df = read_parquet(spark, p) if day is None else read_partition(spark, p, day)
        repeated = dedup.repeated_keys(df, k)
        n = repeated.count()
        if n > dedup.MAX_REPEATED:
            out[t] = _Rows(None, stored(op.dedup_by_key(df, k), f"dedup-{t}"))
            continue
        once, again = dedup.split_repeated(df, k, repeated)
        again = op.dedup_by_key(again, k)
        out[t] = _Rows(once, stored(again, f"dedup-{t}")) if n else _Rows(df)
    return out


def _off_date(rows: DataFrame, sales: DataFrame) -> DataFrame:
    """``_moved``: sales one of whose ``rows`` has another date than the sale has now, and
    those that are gone.  Only sale ids and dates are shuffled, once each."""
    number = lambda d: F.coalesce(F.unix_date(d), F.lit(-(1 << 31)))  # noqa: E731  (no date is a day of its own)
    days = sales.select("sale_id", number(sale_date("timestamp")).alias("_day"))
    held = rows.groupBy("sale_id").agg(F.min(number("date")).alias("_lo"), F.max(number("date")).alias("_hi"))
    same = (F.col("_lo") == F.col("_day")) & (F.col("_hi") == F.col("_day"))
    off = held.join(days, "sale_id", "left").where(~F.coalesce(same, F.lit(False)))
    return off.select(F.col("sale_id").alias("_moved")).distinct()


def _of_sales(rows: DataFrame, moved: DataFrame, how: str) -> DataFrame:
    return rows.join(F.broadcast(moved), F.col("sale_id").eqNullSafe(F.col("_moved")), how)


def _by_own_date(rows: _Rows, sales: DataFrame, name: str, clean: Callable[[DataFrame, bool], DataFrame]) -> _Rows:
    """``clean(rows, dated)`` of all rows: raw rows carry the date of their sale (J1, J2),
    so only those whose sale has another date now, or is gone, must be joined to it again."""
    moved = stored(_off_date(rows.all, sales), f"moved-{name}")
    n = moved.count()
    if n > dedup.MAX_REPEATED:
        return _Rows(None, clean(rows.all, False))
    if n == 0:
        return rows.each(lambda df: clean(df, True))
    kept = rows.each(lambda df: clean(_of_sales(df, moved, "left_anti"), True))
    return _joined(kept, _Rows(None, clean(_of_sales(rows.all, moved, "left_semi"), False)))


def _reference(spark, lake: Lake, name: str, version: str | None, as_of: str | None) -> DataFrame:
    root = lake.table(RAW_REF, name)
    if version is None and as_of is not None:
        return read_version_as_of(spark, root, as_of)
    return read_version(spark, root, version)


def _transform(spark, lake: Lake, raw: dict[str, _Rows], version, as_of, write, *,
               median_method: str, cap, day=None) -> None:
    """Rows that lie in the folder of their date are cleaned and written where they lie,
    as many files a day as there were; the others are shuffled by date.  ``write`` gets the
    rows and the name of the table."""
    products, few_products = broadcast_if_few(_reference(spark, lake, "products", version, as_of))
    stores, few_stores = broadcast_if_few(_reference(spark, lake, "stores", version, as_of))
    p_details = lake.table(CLEANED_TX, "sales_details")
    all_sales = raw["sales"].all
    if cap is None:  # of all lines, wherever their dates are from
        cap = op.clean.price_cap(raw["sales_details"].all, median_method=median_method)
    lines = _by_own_date(raw["sales_details"], all_sales, "sales_details", lambda rows, dated: op.clean_sales_details(
        rows, products, all_sales, cap=cap, dated=dated))
    write(lines if few_products else _Rows(None, lines.all), "sales_details")
    # the line sums of C2 read the published lines instead of recomputing C1; only
    # sales with a zero total are joined to them
    details = read_parquet(spark, p_details) if day is None else read_partition(spark, p_details, day)
    zero = F.coalesce(F.col("total_amount") == 0, F.lit(False))
    sales = _joined(raw["sales"].each(lambda df: op.clean_sales(df.where(~zero), None)),
                    _Rows(None, op.clean_sales(all_sales.where(zero), details)))
    sales = sales.each(lambda df: op.enrich_sales_with_stores(df, stores))
    write(sales if few_stores else _Rows(None, sales.all), "sales")
    # C3 needs only the sale ids and dates, which cleaning does not change
    write(_by_own_date(raw["payments"], all_sales, "payments", lambda rows, dated: op.clean_payments(
        rows, all_sales, dated=dated)), "payments")


def transform_full(spark: SparkSession, lake: Lake, *, version: str | None = None, as_of: str | None = None,
                   median_method: str = "approx", cap=None) -> None:
    """L4: raw -> cleaned for all dates (reference snapshot ``version``, or the
    latest one, or the latest one up to ``as_of``)."""
    _transform(spark, lake, _layer(spark, lake, RAW_TX), version, as_of,
               lambda rows, t: parquet.write_partitioned(rows.by_date(read_parquet(spark, lake.table(RAW_TX, t))),
                                                         lake.table(CLEANED_TX, t), "date", placed=True),
               median_method=median_method, cap=cap)


def transform_daily(spark: SparkSession, lake: Lake, *, day, version: str | None = None, as_of: str | None = None,
                    median_method: str = "approx", cap=None) -> None:
    """Raw -> cleaned for one date partition; a day without raw rows is
    cleared.  The median is the day's unless ``cap`` is passed (e.g. the full
    run's).  The reference snapshot is ``version``, or the latest one up to the
    run date's month ``as_of`` (give the run's own when an old day is rerun), or
    the latest one."""
    _transform(spark, lake, _layer(spark, lake, RAW_TX, to_day(day)), version, as_of,
               lambda rows, t: parquet.replace_partitions(rows.by_date(), lake.table(CLEANED_TX, t), "date", [to_day(day)],
                                                          placed=True),
               median_method=median_method, cap=cap, day=to_day(day))


def transform_changed(spark: SparkSession, lake: Lake, **options) -> list:
    """L5 for the days whose raw sales, lines or payments differ from what was transformed
    last (all days at first); returns them.  Digests by day are kept in the lake and
    renewed last, so a failed run is simply run again.  Options as for ``transform_daily``."""
    now = None
    for t in TX_KEYS:
        d = day_digests(read_parquet(spark, lake.table(RAW_TX, t))).withColumn("table_name", F.lit(t))
        now = d if now is None else now.unionByName(d)
    now = stored(now, "raw-digests")
    path = lake.table(RAW_KEYS, "day_digests")
    try:
        kept = read_parquet(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        kept = now.where("false")
    days = set()
    for t in TX_KEYS:  # a row per calendar day at most
        own = F.col("table_name") == t
        days |= {r.date for r in changed_days(now.where(own), kept.where(own)).where("date is not null").collect()}
    for day in sorted(days):
        transform_daily(spark, lake, day=day, **options)
    parquet.overwrite(now, path)
    return sorted(days)


# ------------------------------------------------------------------ modeling --
def table(spark: SparkSession, lake: Lake, where: tuple[str, str], name: str) -> SnapshotTable | FormatTable:
    return open_table(spark, lake.table(where, name), lake.fmt)


def model_full(spark: SparkSession, lake: Lake) -> None:
    """Cleaned -> dimensions and fact (new snapshots; fact by date)."""
    c = _deduplicated(spark, lake, CLEANED_TX)
    table(spark, lake, CURATED, "dim_product").overwrite(op.create_dim_product(c["sales_details"]))
    table(spark, lake, CURATED, "dim_store").overwrite(op.create_dim_store(c["sales"]))
    dd = table(spark, lake, CURATED, "dim_date")
    dd.overwrite(op.create_dim_date(c["sales"]))
    fact = op.create_fact_sales(c["sales"], c["sales_details"], c["payments"], dd.read(), parts=join_parts(c["sales_details"]), by_date=True,
                                rows=read_parquet(spark, lake.table(CLEANED_TX, "sales_details")).count())
    table(spark, lake, CURATED, "fact_sales").overwrite(fact, "date", placed=True)


def model_daily(spark: SparkSession, lake: Lake, *, day, fact_mode: str = "replace") -> DataFrame:
    """One day of cleaned data -> upsert dimensions on their keys, replace
    (or append) the day in the fact.  Returns the day's fact audit (A10): metrics of
    the write where the day is replaced, a read of the whole day where rows are added."""
    c = _deduplicated(spark, lake, CLEANED_TX, to_day(day))
    dim_date_new = op.create_dim_date(c["sales"])
    table(spark, lake, CURATED, "dim_product").merge(op.create_dim_product(c["sales_details"]), "product_id")
    table(spark, lake, CURATED, "dim_store").merge(op.create_dim_store(c["sales"]), "store_id")
    table(spark, lake, CURATED, "dim_date").merge(dim_date_new, "date_id")
    fact = op.create_fact_sales(c["sales"], c["sales_details"], c["payments"], dim_date_new)
    ft = table(spark, lake, CURATED, "fact_sales")
    if fact_mode == "replace":
        audit = op.WriteAudit()
        ft.replace_partitions(fact, "date", [to_day(day)], observe=audit)
        return audit.frame(spark)
    if fact_mode != "append":
        raise ValueError("fact_mode must be 'replace' or 'append'")
    ft.append(fact, "date")
    return op.audit_counts(ft.read().where(F.col("date") == F.lit(to_day(day))))


# --------------------------------------------------------------- aggregation --
def _curated(spark, lake: Lake) -> dict[str, DataFrame]:
    return {n: table(spark, lake, CURATED, n).read() for n in ("fact_sales", *DIMS)}


def _aggregates(m: dict[str, DataFrame], fact: DataFrame, days: DataFrame | None = None,
                trends: Callable[[], DataFrame] | None = None) -> dict[str, Callable[[], DataFrame]]:
    """``days``: see :func:`.operators.aggregate.create_daily_product_sales`; ``trends`` makes G5 otherwise."""
    return {
        "daily_store_sales": lambda: op.create_daily_store_sales(fact, m["dim_store"]),
        "daily_product_sales": lambda: op.create_daily_product_sales(fact, m["dim_product"], parts=join_parts(fact), days=days),
        "product_sales_trends": trends or (lambda: op.create_product_sales_trends(fact, m["dim_product"], m["dim_date"], parts=join_parts(fact), days=days)),
        "monthly_customer_metrics": lambda: op.create_monthly_customer_metrics(fact),
        "store_performance": lambda: op.create_store_performance_dashboard(fact, m["dim_store"], m["dim_date"]),
    }


PARTITION = {**{n: "date" for n in DAILY_AGGS}, **{n: "month_year" for n in MONTHLY_AGGS}}


def _rows_of(own: SnapshotTable | FormatTable) -> DataFrame | None:
    """The rows of a table, or None where it was written by partition without any row."""
    try:
        return own.read()
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def aggregate_full(spark: SparkSession, lake: Lake) -> None:
    """All five serving tables as new snapshots.  Where the products are few enough to be
    broadcast, the tables by product and day are made and written day by day, by one shuffle.
    G5 reads the published G2, without any, where both have the same groups."""
    m = _curated(spark, lake)
    fact = m["fact_sales"]
    days = day_parts(fact) if broadcast_if_few(m["dim_product"])[1] else None
    dates = op.trading_dates(fact, m["dim_date"])
    trends = None if dates is None else lambda: op.create_product_sales_trends(
        fact, m["dim_product"], m["dim_date"], daily=_rows_of(table(spark, lake, SERVING, "daily_product_sales")), dates=dates)
    rows = fact.count()
    for name, build in _aggregates(m, fact, days, trends).items():
        placed = (days is not None and name == "daily_product_sales"
                  or (days is not None or trends is not None) and name == "product_sales_trends")
        many = rows if name in ("daily_product_sales", "product_sales_trends") else None
        table(spark, lake, SERVING, name).overwrite(build(), PARTITION[name], placed=placed, rows=many)


def aggregate_daily(spark: SparkSession, lake: Lake, *, day) -> None:
    """The day's partitions of the three daily tables (pruned fact read)."""
    m = _curated(spark, lake)
    fact = m["fact_sales"].where(F.col("date") == F.lit(to_day(day)))
    builders = _aggregates(m, fact)
    for name in DAILY_AGGS:
        table(spark, lake, SERVING, name).replace_partitions(builders[name](), "date", [to_day(day)])


def aggregate_monthly(spark: SparkSession, lake: Lake, *, month: str) -> None:
    """The month's partition of the two monthly tables; other months are
    kept, and a month without fact rows is cleared."""
    m = _curated(spark, lake)
    lo, hi = month_range(month)
    fact = m["fact_sales"].where((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))
    builders = _aggregates(m, fact)
    for name in MONTHLY_AGGS:
        table(spark, lake, SERVING, name).replace_partitions(builders[name](), "month_year", [month])


# ------------------------------------------------------------------ dispatch --
MODES = {
    "ingestion": {"full": ingest_full, "daily": ingest_daily, "monthly": ingest_reference},
    "transformation": {"full": transform_full, "daily": transform_daily},
    "modeling": {"full": model_full, "daily": model_daily},
    "aggregation": {"full": aggregate_full, "daily": aggregate_daily, "monthly": aggregate_monthly},
}


def run(stage: str, mode: str, spark: SparkSession, lake: Lake, **params):
    """Run ``stage`` in ``mode`` (both case-insensitive)."""
    jobs = MODES.get(stage.strip().lower())
    if jobs is None:
        raise ValueError(f"stage must be one of {sorted(MODES)}")
    job = jobs.get(mode.strip().lower())
    if job is None:
        raise ValueError(f"{stage} mode must be one of {sorted(jobs)}")
    return job(spark, lake, **params)


__all__ = ["Sources", "ingest_full", "ingest_daily", "ingest_reference", "transform_full",
           "transform_daily", "model_full", "model_daily", "aggregate_full", "aggregate_daily",
           "aggregate_monthly", "run", "MODES", "config"]
