"""DuckDB SQL giving the same tables as the catalog queries, over the test
tables registered as views.  Used only to check results."""

from __future__ import annotations

from .catalog import (CLEANED_AMOUNTS, CURATED_AMOUNTS, NEW_FROM, OFF_TIES, OLD_UNTIL, ONE_DAY, ONE_MONTH,
                      RAW_AMOUNTS, SERVING_AMOUNTS)


RETAIL = """
r_sales AS (
  SELECT o.o_orderkey AS sale_id, c.c_nationkey AS store_id, o.o_orderdate AS "timestamp",
         CASE WHEN o.o_orderkey % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE o.o_totalprice END AS total_amount
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
r_sales_details AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS detail_id,
         l_orderkey AS sale_id, l_partkey AS product_id,
         CASE WHEN l_orderkey % 50 = 7 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         CASE WHEN l_partkey % 40 = 3 THEN CAST(-1 AS DOUBLE) ELSE l_extendedprice / l_quantity END AS unit_price
  FROM lineitem),
r_payments AS (
  SELECT o_orderkey AS payment_id, CASE WHEN o_orderkey % 17 = 5 THEN -o_orderkey ELSE o_orderkey END AS sale_id,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Unknown'
              WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Card' ELSE 'Cash' END AS method,
         o_totalprice AS amount
  FROM orders),
r_products AS (
  SELECT CASE WHEN p_partkey % 30 = 11 THEN -p_partkey ELSE p_partkey END AS product_id, p_name AS name, concat(p_brand, ' ', p_name) AS description,
         p_type AS category, p_retailprice AS unit_price
  FROM part),
r_stores AS (
  SELECT CASE WHEN n_nationkey = 24 THEN -n_nationkey ELSE n_nationkey END AS store_id, n_name AS name, concat('Block ', CAST(n_nationkey AS VARCHAR)) AS address,
         r_name AS town, CAST(5 + n_nationkey % 16 AS INTEGER) AS number_of_employees
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

def _cleaned(payments: str = "r_payments") -> str:
    return f"""
c_med AS (SELECT quantile_disc(unit_price, 0.5) AS m FROM r_sales_details WHERE unit_price > 0),
c_details AS (
  SELECT d.detail_id, d.sale_id, d.product_id, d.quantity,
         CASE WHEN d.unit_price > c_med.m * 5.0 THEN c_med.m * 5.0 ELSE d.unit_price END AS unit_price,
         round(CASE WHEN d.unit_price > c_med.m * 5.0 THEN c_med.m * 5.0 ELSE d.unit_price END * d.quantity * 0.2, 2) AS VAT,
         CAST(s."timestamp" AS DATE) AS date,
         p.name AS product_name, p.description, p.category
  FROM r_sales_details d CROSS JOIN c_med
  LEFT JOIN r_products p ON d.product_id = p.product_id
  LEFT JOIN r_sales s ON d.sale_id = s.sale_id
  WHERE d.quantity > 0 AND d.unit_price > 0),
c_sums AS (SELECT sale_id, sum(unit_price * quantity + VAT) AS calculated_total
           FROM c_details GROUP BY sale_id),
c_sales AS (
  SELECT s.sale_id, s.store_id, s."timestamp",
         CASE WHEN s.total_amount = 0 THEN coalesce(t.calculated_total, CAST(0.01 AS DOUBLE))
              ELSE s.total_amount END AS total_amount,
         CAST(s."timestamp" AS DATE) AS date
  FROM r_sales s LEFT JOIN c_sums t ON s.sale_id = t.sale_id),
c_payments AS (
  SELECT p.payment_id, p.sale_id, CASE WHEN p.method = 'Unknown' THEN 'Card' ELSE p.method END AS method,
         p.amount, CAST(s."timestamp" AS DATE) AS date
  FROM {payments} p JOIN r_sales s ON p.sale_id = s.sale_id),
c_enriched AS (
  SELECT s.*, st.name AS store_name, st.address, st.town, st.number_of_employees
  FROM c_sales s LEFT JOIN r_stores st ON s.store_id = st.store_id)"""


def _dim_date(src: str) -> str:
    return f"""
  SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_id, date,
         CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
         CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year
  FROM (SELECT DISTINCT CAST("timestamp" AS DATE) AS date FROM {src})"""


MODEL = f"""
m_dim_product AS (SELECT DISTINCT product_id, product_name, description, category FROM c_details),
m_dim_store AS (SELECT DISTINCT store_id, store_name, address, town, number_of_employees FROM c_enriched),
m_dim_date AS ({_dim_date("c_enriched")}),
m_fact AS (
  SELECT d.sale_id, d.product_id, s.store_id, dd.date_id, p.method AS payment_method, d.quantity, d.unit_price,
         d.unit_price * d.quantity AS line_amount, d.VAT, CAST(s."timestamp" AS DATE) AS date
  FROM c_details d JOIN c_enriched s ON d.sale_id = s.sale_id
  JOIN c_payments p ON d.sale_id = p.sale_id
  JOIN m_dim_date dd ON CAST(s."timestamp" AS DATE) = dd.date)"""


def with_model(body: str, payments: str = "r_payments", extra: str = "", base: str = RETAIL) -> str:
    return f"WITH {base},{_cleaned(payments)},{MODEL}{extra}\n{body}"


def with_retail(body: str, extra: str = "", base: str = RETAIL) -> str:
    return f"WITH {base}{extra}\n{body}"


def _dedup(table: str, key: str, cols: list[str], corrected: str) -> str:
    order = ", ".join(f'"{c}" ASC NULLS FIRST' for c in cols if c != key)
    step = f"CASE WHEN sale_id % 2 = 0 THEN {corrected} - 1 ELSE {corrected} + 1 END"
    return with_retail(f"""
SELECT * FROM (SELECT * FROM {table}
               UNION ALL SELECT * REPLACE ({step} AS {corrected}) FROM {table} WHERE sale_id % 13 = 0)
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1""")


def g_daily_store(fact: str = "m_fact") -> str:
    return f"""
SELECT f.date, s.store_id, s.store_name, s.town,
       round(sum(f.line_amount), 2) AS daily_sales, CAST(sum(f.quantity) AS BIGINT) AS total_items_sold,
       count(f.sale_id) AS transaction_count, round(avg(f.line_amount), 6) AS avg_transaction_value
FROM {fact} f JOIN m_dim_store s ON f.store_id = s.store_id
GROUP BY f.date, s.store_id, s.store_name, s.town"""


def g_daily_product(fact: str = "m_fact") -> str:
    return f"""
SELECT f.date, p.product_id, p.product_name, p.category,
       round(sum(f.line_amount), 2) AS daily_revenue, CAST(sum(f.quantity) AS BIGINT) AS total_quantity_sold,
       count(f.sale_id) AS times_sold
FROM {fact} f JOIN m_dim_product p ON f.product_id = p.product_id
GROUP BY f.date, p.product_id, p.product_name, p.category"""


def g_monthly(fact: str = "m_fact") -> str:
    return f"""
SELECT strftime(date_trunc('month', f.date), '%Y-%m') AS month_year,
       count(DISTINCT f.sale_id) AS total_transactions, round(sum(f.line_amount), 2) AS monthly_revenue,
       round(avg(f.line_amount), 6) AS avg_sale_amount
FROM {fact} f GROUP BY 1"""


def g_store_perf(fact: str = "m_fact", avg_daily: bool = False) -> str:
    tail = ("""round(sum(f.line_amount) / count(DISTINCT f.date), 6) AS avg_daily_revenue,
       row_number() OVER (ORDER BY s.store_name NULLS FIRST, d.year, d.month) AS position"""
            if avg_daily else
            "concat(CAST(d.year AS VARCHAR), '-', lpad(CAST(d.month AS VARCHAR), 2, '0')) AS month_year")
    return f"""
SELECT s.store_id, s.store_name, s.town, d.year, d.month,
       round(sum(f.line_amount), 2) AS monthly_revenue, CAST(sum(f.quantity) AS BIGINT) AS total_items_sold,
       count(DISTINCT f.sale_id) AS transaction_count, round(avg(f.line_amount), 6) AS avg_transaction_value,
       count(DISTINCT f.date) AS trading_days, {tail}
FROM {fact} f JOIN m_dim_store s ON f.store_id = s.store_id JOIN m_dim_date d ON f.date_id = d.date_id
GROUP BY s.store_id, s.store_name, s.town, d.year, d.month"""


def g_trends(fact: str = "m_fact") -> str:
    return f"""
SELECT p.product_id, p.product_name, p.category, d.year, d.month, d.date,
       round(sum(f.line_amount), 2) AS daily_revenue, CAST(sum(f.quantity) AS BIGINT) AS daily_quantity_sold,
       count(f.sale_id) AS times_sold_today
FROM {fact} f JOIN m_dim_product p ON f.product_id = p.product_id JOIN m_dim_date d ON f.date_id = d.date_id
GROUP BY p.product_id, p.product_name, p.category, d.year, d.month, d.date"""


def _dim_method(src: str, existing: str | None = None) -> str:
    if existing is None:
        return f"""
SELECT CAST(row_number() OVER (ORDER BY method ASC NULLS FIRST) AS BIGINT) AS method_id, method,
       concat('Payment via ', method) AS description
FROM (SELECT DISTINCT method FROM {src})"""
    return f"""
SELECT CAST(coalesce((SELECT max(method_id) FROM {existing}), 0)
            + row_number() OVER (ORDER BY method ASC NULLS FIRST) AS BIGINT) AS method_id, method,
       concat('Payment via ', method) AS description
FROM (SELECT DISTINCT method FROM {src} WHERE method NOT IN (SELECT method FROM {existing}))"""


def _upsert(target: str, source: str, key: str) -> str:
    return f"""
SELECT * FROM {source}
UNION ALL
SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.{key} = t.{key})"""


_OLD = f"date < DATE '{NEW_FROM}'"
_NEW = f"date >= DATE '{OLD_UNTIL}'"
_FACT_DAY = f", m_fact_day AS (SELECT * FROM m_fact WHERE date = DATE '{ONE_DAY}')"
_FACT_MONTH = (f", m_fact_month AS (SELECT * FROM m_fact WHERE date >= DATE '{ONE_MONTH}-01' "
               f"AND date < DATE '{ONE_MONTH}-01' + INTERVAL 1 MONTH)")
_TWO_PAY = """,
r_payments2 AS (SELECT * FROM r_payments
                UNION ALL SELECT -payment_id, sale_id, 'Cash', amount FROM r_payments WHERE sale_id % 19 = 0)"""

_CASH = "(SELECT * FROM r_payments WHERE method = 'Cash')"
_DAY_LO = f"TIMESTAMP '{ONE_DAY} 00:00:00'"

SQL: dict[str, str] = {
    "dedup_sales": _dedup("r_sales", "sale_id", ["sale_id", "store_id", "timestamp", "total_amount"], "total_amount"),
    "dedup_details": _dedup("r_sales_details", "detail_id",
                            ["detail_id", "sale_id", "product_id", "quantity", "unit_price"], "quantity"),
    "dedup_payments": _dedup("r_payments", "payment_id", ["payment_id", "sale_id", "method", "amount"], "amount"),
    "ingest_details_by_sale": with_retail("""
SELECT d.sale_id, d.detail_id, d.product_id, d.quantity, d.unit_price, CAST(s."timestamp" AS DATE) AS date
FROM r_sales_details d JOIN r_sales s ON d.sale_id = s.sale_id"""),
    "ingest_payments_by_sale": with_retail("""
SELECT p.sale_id, p.payment_id, p.method, p.amount, CAST(s."timestamp" AS DATE) AS date
FROM r_payments p JOIN r_sales s ON p.sale_id = s.sale_id"""),
    "ingest_increment": with_retail(f"""
SELECT d.sale_id, d.detail_id, d.product_id, d.quantity, d.unit_price, CAST(s."timestamp" AS DATE) AS date
FROM r_sales_details d JOIN r_sales s ON d.sale_id = s.sale_id
WHERE s."timestamp" >= {_DAY_LO} AND s."timestamp" < {_DAY_LO} + INTERVAL 1 DAY"""),
    "median_price": with_retail("""
SELECT any_value(m) AS median_price, count(unit_price) AS positive_count,
       count(CASE WHEN unit_price <= m THEN 1 END) AS at_or_below
FROM r_sales_details CROSS JOIN med WHERE unit_price > 0""",
                                extra=""",
med AS (SELECT quantile_disc(unit_price, 0.5) AS m FROM r_sales_details WHERE unit_price > 0)"""),
    "median_price_approx": with_retail(
        "SELECT count(*) AS positive_count, true AS within_error FROM r_sales_details WHERE unit_price > 0"),
    "clean_sales_details": with_model("SELECT * FROM c_details"),
    "clean_sales": with_model("SELECT * REPLACE (round(total_amount, 2) AS total_amount) FROM c_sales"),
    "clean_payments": with_model("SELECT * FROM c_payments"),
    "enrich_sales": with_model("SELECT * REPLACE (round(total_amount, 2) AS total_amount) FROM c_enriched"),
    "dim_product": with_model("SELECT * FROM m_dim_product"),
    "dim_store": with_model("SELECT * FROM m_dim_store"),
    "dim_date": with_model("SELECT * FROM m_dim_date"),
    "fact_sales": with_model("SELECT * FROM m_fact"),
    "fact_sales_two_payments": with_model("SELECT * FROM m_fact", payments="r_payments2", extra="")
        .replace(f"WITH {RETAIL},", f"WITH {RETAIL}{_TWO_PAY},", 1),
    "daily_store_sales": with_model(g_daily_store()),
    "daily_product_sales": with_model(g_daily_product()),
    "monthly_customer_metrics": with_model(g_monthly()),
    "store_performance": with_model(g_store_perf()),
    "product_sales_trends": with_model(g_trends()),
    "daily_store_sales_one_day": with_model(g_daily_store("m_fact_day"), extra=_FACT_DAY),
    "store_performance_one_month": with_model(g_store_perf("m_fact_month"), extra=_FACT_MONTH),
    "dim_payment_method": with_retail(_dim_method("r_payments")),
    "dim_payment_method_new": with_retail(_dim_method("r_payments", "existing"),
                                          extra=f",\nexisting AS ({_dim_method(_CASH)})"),
    "fact_sales_method_id": with_model("""
SELECT f.sale_id, f.product_id, f.store_id, f.date_id, pm.method_id, f.quantity, f.unit_price, f.line_amount,
       f.VAT, f.date
FROM m_fact f JOIN m_dim_method pm ON f.payment_method = pm.method""",
                                       extra=f", m_dim_method AS ({_dim_method('c_payments')})"),
    "store_performance_avg_daily": with_model(g_store_perf(avg_daily=True)),
    "upsert_dim_product": with_model(_upsert("t_old", "t_new", "product_id"), extra=f""",
t_old AS (SELECT DISTINCT product_id, product_name, description, category FROM c_details WHERE {_OLD}),
t_new AS (SELECT DISTINCT product_id, product_name, upper(description) AS description, category FROM c_details WHERE {_NEW})"""),
    "upsert_dim_store": with_model(_upsert("t_old", "t_new", "store_id"), extra=f""",
t_old AS (SELECT DISTINCT store_id, store_name, address, town, number_of_employees FROM c_enriched WHERE {_OLD}),
t_new AS (SELECT DISTINCT store_id, store_name, address, upper(town) AS town, number_of_employees FROM c_enriched WHERE {_NEW})"""),
    "upsert_dim_date": with_model(_upsert("t_old", "t_new", "date_id"), extra=f""",
t_old AS (SELECT * REPLACE (CAST(0 AS INTEGER) AS quarter) FROM ({_dim_date(f"(SELECT * FROM c_enriched WHERE date < DATE '{NEW_FROM}')")})),
t_new AS ({_dim_date(f"(SELECT * FROM c_enriched WHERE date >= DATE '{OLD_UNTIL}')")})"""),
    "audit_counts": with_model("""
SELECT count(*) AS row_count, count(DISTINCT date) AS distinct_dates, min(date) AS min_date, max(date) AS max_date
FROM m_fact"""),
}

_FACT_REPLACED_MONTH = (f", m_fact_rm AS (SELECT * FROM m_fact WHERE NOT (date >= DATE '{ONE_MONTH}-01' "
                        f"AND date < DATE '{ONE_MONTH}-01' + INTERVAL 1 MONTH) OR payment_method = 'Card')")
_T_OLD_PRODUCT = f""",
t_old AS (SELECT DISTINCT product_id, product_name, description, category FROM c_details WHERE {_OLD})"""


def totals(tables: dict[str, tuple[str, str, str]], by: str | None = None) -> str:
    """Row count, key sum and amount of each (source, key, amount), by a column if given."""
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, {by + ',' if by else ''} count(*) AS row_count, "
        f"CAST(sum({key}) AS BIGINT) AS key_sum, round(sum(CAST({amount} AS DOUBLE)) + {OFF_TIES}, 2) AS amount "
        f"FROM {source} {'GROUP BY ' + by if by else ''}" for name, (source, key, amount) in tables.items())


def _from(amounts: dict, **source: str) -> dict[str, tuple[str, str, str]]:
    return {t: (source[t], *amounts[t]) for t in source}


_RAW = ", ".join(f"""
raw_{t} AS (SELECT x.*, CAST(s."timestamp" AS DATE) AS date FROM r_{t} x JOIN r_sales s ON x.sale_id = s.sale_id)"""
                 for t in ("sales_details", "payments"))
_RAW_SALES = """,
raw_sales AS (SELECT *, CAST("timestamp" AS DATE) AS date FROM r_sales),""" + _RAW
_RAW_SOURCES = dict(sales="raw_sales", sales_details="raw_sales_details", payments="raw_payments")
_AFTER_DAY = {
    "sales": f"(SELECT * REPLACE (CASE WHEN date = DATE '{ONE_DAY}' THEN total_amount + 1 ELSE total_amount END "
             "AS total_amount) FROM raw_sales)",
    "sales_details": "raw_sales_details",
    "payments": f"(SELECT * FROM raw_payments WHERE NOT (date = DATE '{ONE_DAY}' AND method = 'Card'))"}
_CLEANED = _from(CLEANED_AMOUNTS, sales="c_enriched", sales_details="c_details", payments="c_payments")
_CURATED = _from(CURATED_AMOUNTS, dim_product="m_dim_product", dim_store="m_dim_store", dim_date="m_dim_date",
                 fact_sales="m_fact")
_SERVING = _from(SERVING_AMOUNTS, daily_store_sales="s_daily_store", daily_product_sales="s_daily_product",
                 product_sales_trends="s_trends", monthly_customer_metrics="s_monthly", store_performance="s_store_perf")


def _plain(sql: str) -> str:
    """The serving query without its presentation rounding of sums."""
    return sql.replace("round(sum(f.line_amount), 2)", "sum(f.line_amount)")


_SERVED = f""",
s_daily_store AS ({_plain(g_daily_store())}), s_daily_product AS ({_plain(g_daily_product())}),
s_trends AS ({_plain(g_trends())}), s_monthly AS ({_plain(g_monthly())}), s_store_perf AS ({_plain(g_store_perf())})"""
_DAILY = {t: _SERVING[t] for t in ("daily_store_sales", "daily_product_sales", "product_sales_trends")}
_MONTHS = {t: _SERVING[t] for t in ("monthly_customer_metrics", "store_performance")}


SQL.update({
    "ingest_full": with_retail(
        totals(_from(RAW_AMOUNTS, **_RAW_SOURCES) | {
            "products": ("r_products", "product_id", "unit_price"),
            "stores": ("r_stores", "store_id", "number_of_employees")}), extra=_RAW_SALES),
    "ingest_daily": SQL["ingest_increment"],
    "ingest_daily_on_history": with_retail(totals(_from(RAW_AMOUNTS, **_AFTER_DAY), "date"), extra=_RAW_SALES),
    "transform_full": with_model(totals(_CLEANED)),
    "transform_daily": with_model(totals(_CLEANED, "date")),
    "model_full": with_model(totals(_CURATED)),
    "model_daily": with_model(totals({"fact_sales": _CURATED["fact_sales"]}, "date")),
    "model_daily_dimensions": with_model(f"""
SELECT 'dim_product' AS table_name, product_id AS id,
       CASE WHEN product_id IN (SELECT product_id FROM c_details WHERE date = DATE '{ONE_DAY}') THEN category ELSE 'stale' END AS attribute
FROM m_dim_product
UNION ALL
SELECT 'dim_store', CAST(store_id AS BIGINT),
       CASE WHEN store_id IN (SELECT store_id FROM c_enriched WHERE date = DATE '{ONE_DAY}') THEN town ELSE 'stale' END
FROM m_dim_store"""),
    "aggregate_full": with_model(totals(_SERVING), extra=_SERVED),
    "aggregate_daily": with_model(totals(_DAILY, "date"), extra=_SERVED),
    "aggregate_monthly": with_model(totals(_MONTHS, "month_year"), extra=_SERVED),
    "replace_day": with_model(f"SELECT * FROM m_fact WHERE date <> DATE '{ONE_DAY}' OR payment_method = 'Card'"),
    "replace_empty_day": with_model(f"SELECT * FROM m_fact WHERE date <> DATE '{ONE_DAY}'"),
    "replace_month": with_model(g_store_perf("m_fact_rm"), extra=_FACT_REPLACED_MONTH),
    "append_day": with_model("SELECT * FROM m_fact"),
    "snapshot_as_of_version": with_model("SELECT * FROM t_old", extra=_T_OLD_PRODUCT),
    "snapshot_as_of_time": with_model("SELECT * FROM t_old", extra=_T_OLD_PRODUCT),
    "snapshot_latest": SQL["upsert_dim_product"],
    "parquet_roundtrip": SQL["clean_payments"],
    "csv_reference": with_retail("SELECT * FROM r_products"),
    "ingest_reference": with_retail("""
SELECT 'products' AS table_name, count(*) AS row_count FROM r_products
UNION ALL
SELECT 'stores' AS table_name, count(*) AS row_count FROM r_stores"""),
})
