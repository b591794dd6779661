"""Named queries over stored layouts and kept states, with their DuckDB SQL: bucketed
tables, dynamic partition pruning, daily states, versioned references, key index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .. import operators as op
from ..functions.dates import sale_date, to_day
from ..operators import asof, colocated, digests, ids, pruning, states
from ..session import fresh_path, stored
from ..sinks import parquet
from ..sinks.bucketed import read_bucketed, write_bucketed
from ..sinks.keyindex import KeyIndex
from ..sources import retail
from ..sources.factory import make_sources
from ..sources.layout import Lake
from . import jobs, sql_oracle
from .catalog import G4_R, OFF_TIES, REF_VERSION, Query, Retail, _round

#: Buckets of the sale tables in these queries.
BUCKETS = 16
#: Reference versions and the attribute that tells them apart.
VERSIONS = ("1993-01", "1995-06", "1997-10")
REPLAY_DAY = "2002-03-01"


def _off_ties(df: DataFrame, column: str = "monthly_revenue") -> DataFrame:
    return df.withColumn(column, F.col(column) + OFF_TIES)


def sale_buckets(spark: SparkSession, sf_dir: str, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """sales, sales_details and payments stored in buckets of sale_id."""
    i = retail.retail_inputs(spark, sf_dir)
    out = {}
    for name, df in (("sales", i.sales), ("sales_details", i.sales_details), ("payments", i.payments)):
        path = fresh_path(spark, f"buckets-{name}")
        write_bucketed(df, path, "sale_id", buckets)
        out[name] = read_bucketed(spark, path, "sale_id", buckets)
    return out


def q_bucketed_ingest_details(spark, sf_dir):
    b = sale_buckets(spark, sf_dir)
    return colocated.dated_children(b["sales_details"], b["sales"])


def q_bucketed_ingest_payments(spark, sf_dir):
    b = sale_buckets(spark, sf_dir)
    return colocated.dated_children(b["payments"], b["sales"])


def q_bucketed_clean_sales(spark, sf_dir):
    b = sale_buckets(spark, sf_dir)
    lines = colocated.priced_lines(b["sales_details"], median_method="exact")
    return _round(colocated.sale_totals(b["sales"], lines), r2=["total_amount"])


def q_bucketed_clean_payments(spark, sf_dir):
    b = sale_buckets(spark, sf_dir)
    return colocated.paid_sales(b["payments"], b["sales"])


def bucketed_fact(spark, sf_dir, **options) -> DataFrame:
    b = sale_buckets(spark, sf_dir)
    lines = colocated.priced_lines(b["sales_details"], median_method="exact")
    payments = colocated.paid_sales(b["payments"], b["sales"])
    return colocated.colocated_fact(b["sales"], lines, payments, op.create_dim_date(b["sales"]), **options)


def q_bucketed_fact_sales(spark, sf_dir):
    return bucketed_fact(spark, sf_dir)


def dated_fact(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The fact as a table partitioned by date, and dim_date as a stored table."""
    r = Retail(spark, sf_dir)
    path = fresh_path(spark, "dated-fact")
    parquet.write_partitioned(r.fact, path, "date")
    return spark.read.parquet(path), stored(r.dim_date, "dated-days")


QUARTER = "year = 1997 AND quarter = 2"


def q_quarter_revenue(spark, sf_dir):
    """A quarter chosen on dim_date."""
    fact, days = dated_fact(spark, sf_dir)
    return _round(_off_ties(pruning.revenue_by(fact, days, QUARTER, ("year", "quarter", "month")), "revenue"), r2=["revenue"])


def kept_sales_states(spark, sf_dir) -> tuple[DataFrame, Retail]:
    r = Retail(spark, sf_dir)
    return stored(states.sales_states(r.fact), "sales-states"), r


def q_monthly_metrics_from_states(spark, sf_dir):
    """G3, A8, L10 from daily states."""
    kept, _ = kept_sales_states(spark, sf_dir)
    return _round(_off_ties(states.monthly_metrics(kept)), r2=["monthly_revenue"], r6=["avg_sale_amount"])


def q_store_performance_from_states(spark, sf_dir):
    """G4, A8, L10 from daily states."""
    kept, r = kept_sales_states(spark, sf_dir)
    return _round(_off_ties(states.store_dashboard(kept, r.dim_store)), **G4_R)


def q_history_median(spark, sf_dir):
    """The median merged from daily sketches stays within its rank error."""
    i = retail.retail_inputs(spark, sf_dir)
    lines = colocated.dated_children(i.sales_details, i.sales)
    kept = stored(states.price_states(lines), "price-states")
    positive = lines.where(F.col("unit_price") > 0).withColumn("m", F.lit(states.history_median(kept)))
    p, m = F.col("unit_price"), F.col("m")
    below, upto = F.count(F.when(p < m, 1)) / F.count("*"), F.count(F.when(p <= m, 1)) / F.count("*")
    return positive.agg(F.count("*").alias("positive_count"), ((upto >= 0.49) & (below <= 0.51)).alias("within_error"))


def _versioned(df: DataFrame, name: str, changed: str) -> DataFrame:
    """Three snapshots of a reference table; ``changed`` carries the version, and the
    second snapshot lacks every seventh key."""
    root = fresh_path(df.sparkSession, name)
    for n, v in enumerate(VERSIONS):
        snapshot = df.withColumn(changed, F.concat(F.lit(f"{v} "), F.col(changed)))
        key = df.columns[0]
        parquet.write_once(snapshot.where(F.col(key) % 7 != 0) if n == 1 else snapshot, f"{root}/version={v}")
    return asof.read_versions(df.sparkSession, root)


def q_details_as_of(spark, sf_dir):
    """R4v, J3: lines with the product attributes that held in their sale's month."""
    i = retail.retail_inputs(spark, sf_dir)
    versions = _versioned(i.products.select("product_id", F.col("name").alias("product_name"), "category"), "asof-products", "product_name")
    return asof.join_as_of(colocated.dated_children(i.sales_details, i.sales), versions, "product_id")


def q_sales_as_of(spark, sf_dir):
    """R4v, J7: sales with the store attributes that held in their month."""
    i = retail.retail_inputs(spark, sf_dir)
    versions = _versioned(i.stores.select("store_id", F.col("name").alias("store_name"), "town"), "asof-stores", "town")
    return asof.join_as_of(i.sales.withColumn("date", sale_date("timestamp")), versions, "store_id")


def q_ingest_replay_once(spark, sf_dir):
    """A1, L2 across days: all history is indexed; an increment then brings a part of it
    again on REPLAY_DAY with another total, and as many new sales.  The replayed ones go."""
    sales = retail.sales(spark, sf_dir).withColumn("date", sale_date("timestamp"))
    index = KeyIndex(spark, fresh_path(spark, "sale-index"), "sale_id", range_keys=1 << 14)
    index.add(sales)
    again = sales.where(F.col("sale_id") % 7 == 0).withColumns(
        {"date": F.lit(to_day(REPLAY_DAY)), "total_amount": F.col("total_amount") + 1})
    increment = again.unionByName(again.withColumn("sale_id", F.col("sale_id") + 100_000_000))
    for _ in range(2):  # the second run of the day changes nothing
        fresh = stored(index.unseen(increment), "unseen")
        index.add(fresh)
    return sales.unionByName(fresh).drop("timestamp")


def q_changed_days(spark, sf_dir):
    """Digests of all days are kept; then some sales are altered, some deleted and
    some moved to another day.  The days concerned, and only these, are told."""
    before = retail.sales(spark, sf_dir).withColumn("date", sale_date("timestamp"))
    kept = stored(digests.day_digests(before), "day-digests")
    k = F.col("sale_id")
    after = before.where(k % 991 != 2).withColumns({
        "total_amount": F.when(k % 997 == 1, F.col("total_amount") + 1).otherwise(F.col("total_amount")),
        "date": F.when(k % 983 == 3, F.date_add("date", 40)).otherwise(F.col("date"))})
    return digests.changed_days(digests.day_digests(after), kept)


def q_dense_product_ids(spark, sf_dir):
    """Ids of all products sold."""
    return ids.dense_ids(retail.sales_details(spark, sf_dir), ["product_id"], "product_key")


def q_audit_of_write(spark, sf_dir):
    """A10 while writing: the fact's audit, as metrics of its write by date."""
    audit = op.WriteAudit()
    parquet.write_partitioned(Retail(spark, sf_dir).fact, fresh_path(spark, "audited-fact"), "date", observe=audit)
    return audit.frame(spark)


def damaged_products_csv(spark, sf_dir) -> str:
    """The products as CSV with prices in whole cents and every fifth name quoted with a comma;
    some lines have a word as price, a field too many, a field too few or no product_id."""
    k = F.abs("product_id")
    name = F.when(k % 5 == 0, F.concat(F.lit('"'), "name", F.lit(', "" new"'))).otherwise(F.col("name"))
    price = F.when(k % 11 == 2, "free").otherwise(F.round(F.col("unit_price") * 100).cast("long").cast("string"))
    key = F.when(k % 19 != 5, F.col("product_id").cast("string")).otherwise("")
    line = F.concat_ws(",", key, name, "description", F.when(k % 17 != 4, F.col("category")), price,
                       F.when(k % 13 == 3, "more"))
    path = fresh_path(spark, "damaged-csv")
    products = retail.products(spark, sf_dir)
    (products.select(line.alias(",".join(products.columns)))  # one column, so lines are written as they are
     .write.option("header", True).option("sep", "\t").option("quote", "\x01").option("escape", "\x01").csv(path))
    return path


def q_csv_bad_lines(spark, sf_dir):
    """R1, L1, L3 with bad lines: the monthly reference job over a damaged file; kept and
    rejected rows as they were published."""
    stores = retail.stores(spark, sf_dir)
    stores_path, lake = fresh_path(spark, "stores-csv"), Lake(fresh_path(spark, "lake-checked"))
    stores.write.option("header", True).csv(stores_path)
    schema = retail.products(spark, sf_dir).schema
    src = make_sources(retail.TestTableSource(sf_dir), damaged_products_csv(spark, sf_dir), stores_path,
                       products_schema=schema, stores_schema=stores.schema, checked=True)
    jobs.run("ingestion", "monthly", spark, lake, src=src, version=REF_VERSION)
    kept = spark.read.parquet(lake.table(config.RAW_REF, "products", REF_VERSION))
    rejected = spark.read.parquet(lake.table(config.RAW_REJECTED, "products", REF_VERSION))
    return kept.unionByName(rejected, allowMissingColumns=True)


QUERIES: dict[str, Query] = {
    "audit_of_write": q_audit_of_write,
    "csv_bad_lines": q_csv_bad_lines,
    "changed_days": q_changed_days,
    "dense_product_ids": q_dense_product_ids,
    "bucketed_ingest_details": q_bucketed_ingest_details,
    "bucketed_ingest_payments": q_bucketed_ingest_payments,
    "bucketed_clean_sales": q_bucketed_clean_sales,
    "bucketed_clean_payments": q_bucketed_clean_payments,
    "bucketed_fact_sales": q_bucketed_fact_sales,
    "quarter_revenue": q_quarter_revenue,
    "monthly_metrics_from_states": q_monthly_metrics_from_states,
    "store_performance_from_states": q_store_performance_from_states,
    "history_median": q_history_median,
    "details_as_of": q_details_as_of,
    "sales_as_of": q_sales_as_of,
    "ingest_replay_once": q_ingest_replay_once,
}

_LIST = ", ".join(f"('{v}', {n})" for n, v in enumerate(VERSIONS))
_HELD = f""",
held AS (SELECT * FROM (VALUES {_LIST}) AS t(version, nth)),
dated AS (SELECT s.*, CAST(s."timestamp" AS DATE) AS date,
                 (SELECT max(version) FROM held WHERE version <= strftime(s."timestamp", '%Y-%m')) AS version FROM r_sales s)"""


def _as_of(table: str, key: str, columns: str) -> str:
    return f"(SELECT version, {key}, {columns} FROM {table}, held WHERE nth <> 1 OR {key} % 7 <> 0)"


def _sums_off_ties(name: str) -> str:
    return sql_oracle.SQL[name].replace("round(sum(f.line_amount), 2)", f"round(sum(f.line_amount) + {OFF_TIES}, 2)")


SQL: dict[str, str] = {
    "audit_of_write": sql_oracle.SQL["audit_counts"],
    "csv_bad_lines": sql_oracle.with_retail("""
SELECT CASE WHEN reason IS NULL THEN product_id END AS product_id,
       CASE WHEN reason IS NULL THEN CASE WHEN k % 5 = 0 THEN concat(name, ', " new') ELSE name END END AS name,
       CASE WHEN reason IS NULL THEN description END AS description, CASE WHEN reason IS NULL THEN category END AS category,
       CASE WHEN reason IS NULL THEN round(unit_price * 100) END AS unit_price,
       CASE WHEN reason = 'no product_id' THEN json_fields WHEN reason IS NOT NULL THEN line END AS line, reason
FROM (SELECT *, CASE WHEN k % 17 = 4 AND k % 13 <> 3 THEN 'wrong number of fields'
                     WHEN k % 17 = 4 AND k % 13 = 3 THEN 'unit_price: not double'
                     WHEN k % 11 = 2 THEN 'unit_price: not double'
                     WHEN k % 13 = 3 THEN 'wrong number of fields'
                     WHEN k % 19 = 5 THEN 'no product_id' END AS reason,
             concat_ws(',', key, quoted, description, CASE WHEN k % 17 <> 4 THEN category END, price,
                       CASE WHEN k % 13 = 3 THEN 'more' END) AS line,
             concat('{"name":', to_json(CASE WHEN k % 5 = 0 THEN concat(name, ', " new') ELSE name END), ',"description":', to_json(description),
                    ',"category":', to_json(category), ',"unit_price":', price, '.0}') AS json_fields
      FROM (SELECT *, abs(product_id) AS k,
                   CASE WHEN abs(product_id) % 19 <> 5 THEN CAST(product_id AS VARCHAR) ELSE '' END AS key,
                   CASE WHEN abs(product_id) % 5 = 0 THEN concat('"', name, ', "" new"') ELSE name END AS quoted,
                   CASE WHEN abs(product_id) % 11 = 2 THEN 'free' ELSE CAST(CAST(round(unit_price * 100) AS BIGINT) AS VARCHAR) END AS price
            FROM r_products))"""),
    "changed_days": sql_oracle.with_retail("""
SELECT date, CASE WHEN date NOT IN (SELECT date FROM b) THEN 'new' WHEN date NOT IN (SELECT date FROM a) THEN 'gone'
                  ELSE 'changed' END AS status
FROM (SELECT date FROM (FROM b EXCEPT ALL FROM a) UNION SELECT date FROM (FROM a EXCEPT ALL FROM b))""", extra=""",
b AS (SELECT s.*, CAST(s."timestamp" AS DATE) AS date FROM r_sales s),
a AS (SELECT sale_id, store_id, "timestamp", CASE WHEN sale_id % 997 = 1 THEN total_amount + 1 ELSE total_amount END AS total_amount,
             CASE WHEN sale_id % 983 = 3 THEN CAST(date + INTERVAL 40 DAY AS DATE) ELSE date END AS date FROM b WHERE sale_id % 991 <> 2)"""),
    "dense_product_ids": sql_oracle.with_retail("""
SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id FROM (SELECT DISTINCT product_id FROM r_sales_details)"""),
    "bucketed_ingest_details": sql_oracle.SQL["ingest_details_by_sale"],
    "bucketed_ingest_payments": sql_oracle.SQL["ingest_payments_by_sale"],
    "bucketed_clean_sales": sql_oracle.SQL["clean_sales"],
    "bucketed_clean_payments": sql_oracle.SQL["clean_payments"],
    "bucketed_fact_sales": sql_oracle.SQL["fact_sales"],
    "quarter_revenue": sql_oracle.with_model(f"""
SELECT d.year, d.quarter, d.month, f.store_id, round(sum(f.line_amount) + {OFF_TIES}, 2) AS revenue,
       CAST(sum(f.quantity) AS BIGINT) AS items, count(*) AS fact_rows
FROM m_fact f JOIN m_dim_date d ON f.date_id = d.date_id WHERE d.year = 1997 AND d.quarter = 2
GROUP BY d.year, d.quarter, d.month, f.store_id"""),
    "monthly_metrics_from_states": _sums_off_ties("monthly_customer_metrics"),
    "store_performance_from_states": _sums_off_ties("store_performance"),
    "history_median": sql_oracle.with_retail("""
SELECT count(*) AS positive_count, true AS within_error
FROM r_sales_details d JOIN r_sales s ON d.sale_id = s.sale_id WHERE unit_price > 0"""),
    "details_as_of": sql_oracle.with_retail(f"""
SELECT d.detail_id, d.sale_id, d.product_id, d.quantity, d.unit_price, s.date, p.product_name, p.category, s.version
FROM r_sales_details d JOIN dated s ON d.sale_id = s.sale_id
LEFT JOIN {_as_of("r_products", "product_id", "concat(version, ' ', name) AS product_name, category")} p
  ON p.version = s.version AND p.product_id = d.product_id""", extra=_HELD),
    "sales_as_of": sql_oracle.with_retail(f"""
SELECT s.sale_id, s.store_id, s."timestamp", s.total_amount, s.date, t.store_name, t.town, s.version
FROM dated s LEFT JOIN {_as_of("r_stores", "store_id", "name AS store_name, concat(version, ' ', town) AS town")} t
  ON t.version = s.version AND t.store_id = s.store_id""", extra=_HELD),
    "ingest_replay_once": sql_oracle.with_retail(f"""
SELECT sale_id, store_id, total_amount, CAST("timestamp" AS DATE) AS date FROM r_sales
UNION ALL
SELECT sale_id + 100000000, store_id, total_amount + 1, DATE '{REPLAY_DAY}' FROM r_sales WHERE sale_id % 7 = 0"""),
}
