"""Retail tables derived from the TPC-H-style test tables.

The mapping injects deterministic dirt so that every cleaning branch fires on
whole tables (zero totals, zero quantities, negative prices, Unknown methods,
payments of no sale and sales without payment, lines without product, sales
without store).  The modulo expressions choose which rows are dirty: a key is
made to match nothing by negating it.  No row of a table is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class RetailInputs:
    sales: DataFrame
    sales_details: DataFrame
    payments: DataFrame
    products: DataFrame
    stores: DataFrame


def _orphaned(key: str, dirty) -> Column:
    """The key, or for dirty rows its negative, which matches nothing."""
    return F.when(dirty, -F.col(key)).otherwise(F.col(key))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_test_table(spark, sf_dir, "orders")
    c = read_test_table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("c_nationkey").alias("store_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("total_amount"),
    )


def sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_test_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                    F.to_date("l_shipdate").cast("string")).alias("detail_id"),
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_orderkey") % 50 == 7, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.when(F.col("l_partkey") % 40 == 3, F.lit(-1.0))
         .otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_test_table(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("payment_id"),
        _orphaned("o_orderkey", F.col("o_orderkey") % 17 == 5).alias("sale_id"),
        F.when(pr == "4-NOT SPECIFIED", F.lit("Unknown"))
         .when(pr.isin("1-URGENT", "2-HIGH"), F.lit("Card"))
         .otherwise(F.lit("Cash")).alias("method"),
        F.col("o_totalprice").alias("amount"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_test_table(spark, sf_dir, "part")
    return p.select(
        _orphaned("p_partkey", F.col("p_partkey") % 30 == 11).alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("description"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_test_table(spark, sf_dir, "nation")
    r = read_test_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        _orphaned("n_nationkey", F.col("n_nationkey") == 24).alias("store_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("Block "), F.col("n_nationkey").cast("string")).alias("address"),
        F.col("r_name").alias("town"),
        (F.lit(5) + F.col("n_nationkey") % 16).alias("number_of_employees"),
    )


def retail_inputs(spark: SparkSession, sf_dir: str) -> RetailInputs:
    return RetailInputs(sales(spark, sf_dir), sales_details(spark, sf_dir), payments(spark, sf_dir),
                        products(spark, sf_dir), stores(spark, sf_dir))


def replayed(df: DataFrame, column: str, key: str = "sale_id", every: int = 13) -> DataFrame:
    """The feed with every row whose ``key % every = 0`` delivered a second
    time, as a replayed ingest would (input for the dedup operator).  The replay
    is corrected: ``column`` is one more where the key is odd and one less where
    it is even, so the rows of a key differ and the tie rule decides."""
    step = F.when(F.col(key) % 2 == 0, -1).otherwise(1)
    again = df.where(F.col(key) % every == 0)
    return df.unionByName(again.withColumn(column, (F.col(column) + step).cast(df.schema[column].dataType)))


def with_second_payment(pay: DataFrame, every: int = 19) -> DataFrame:
    """Payments plus a second 'Cash' payment (negated id) for every sale with
    ``sale_id % every = 0``: the two-payment fan-out of the fact grain."""
    extra = pay.where(F.col("sale_id") % every == 0).select(
        (-F.col("payment_id")).alias("payment_id"), "sale_id", F.lit("Cash").alias("method"), "amount")
    return pay.unionByName(extra)


@dataclass(frozen=True)
class TestTableSource:
    """Transactional and reference tables of one test-data folder, in the
    shape the jobs read from a database and from reference files."""
    sf_dir: str

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        return {"sales": sales, "sales_details": sales_details, "payments": payments}[table](spark, self.sf_dir)

    def products(self, spark: SparkSession) -> DataFrame:
        return products(spark, self.sf_dir)

    def stores(self, spark: SparkSession) -> DataFrame:
        return stores(spark, self.sf_dir)
