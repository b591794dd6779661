"""Ready sources for the jobs: transactions from a database or a folder of
Parquet tables, reference tables from CSV files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas
from ..plans.jobs import Sources
from .files import read_csv, read_csv_checked, read_parquet

Transactions = Callable[[SparkSession, str], DataFrame]


def parquet_transactions(root: str) -> Transactions:
    """Tables as Parquet folders ``root/<table>``."""
    return lambda spark, table: read_parquet(spark, f"{root.rstrip('/')}/{table}")


def make_sources(transactions: Transactions, products_csv: str, stores_csv: str, *,
                 products_schema: StructType | None = schemas.PRODUCTS,
                 stores_schema: StructType | None = schemas.STORES, checked: bool = False) -> Sources:
    """``transactions`` is a :class:`~shelfline.sources.jdbc.JdbcSource` or any
    function of (spark, table); the reference files are CSV with a header and
    declared types (``None`` infers them).  With ``checked`` (declared types only) lines
    that do not parse or lack their key are kept out of the snapshots, in tables of their own."""
    if checked:
        return Sources(transactions=transactions,
                       products=lambda spark: read_csv_checked(spark, products_csv, products_schema, "product_id"),
                       stores=lambda spark: read_csv_checked(spark, stores_csv, stores_schema, "store_id"))
    return Sources(transactions=transactions,
                   products=lambda spark: read_csv(spark, products_csv, products_schema),
                   stores=lambda spark: read_csv(spark, stores_csv, stores_schema))
