"""Business operators: DataFrame in, DataFrame out, nothing executed eagerly
except the exact median (a few bounded aggregation jobs)."""
from .dedup import dedup_by_key
from .clean import clean_sales_details, clean_sales, clean_payments, enrich_sales_with_stores
from .model import (create_dim_product, create_dim_store, create_dim_date, create_fact_sales,
                    create_dim_payment_method, create_fact_sales_with_method_id)
from .aggregate import (create_daily_store_sales, create_daily_product_sales,
                        create_monthly_customer_metrics, create_store_performance_dashboard,
                        create_product_sales_trends, create_store_performance_avg_daily, trading_dates)
from .merge import upsert, replace_partitions, append_rows
from .audit import WriteAudit, audit_counts

__all__ = [n for n in dir() if not n.startswith("_")]
