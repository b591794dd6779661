"""Declared schemas of the retail tables (reading CSV with ``schema=`` instead
of inference keeps types stable between loads)."""

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

PRODUCTS = StructType([
    StructField("product_id", StringType()),
    StructField("name", StringType()),
    StructField("description", StringType()),
    StructField("category", StringType()),
    StructField("unit_price", DoubleType()),
])

STORES = StructType([
    StructField("store_id", StringType()),
    StructField("name", StringType()),
    StructField("address", StringType()),
    StructField("town", StringType()),
    StructField("number_of_employees", IntegerType()),
])

SALES = StructType([
    StructField("sale_id", LongType()),
    StructField("store_id", IntegerType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("total_amount", DoubleType()),
])

SALES_DETAILS = StructType([
    StructField("detail_id", StringType()),
    StructField("sale_id", LongType()),
    StructField("product_id", LongType()),
    StructField("quantity", IntegerType()),
    StructField("unit_price", DoubleType()),
])

PAYMENTS = StructType([
    StructField("payment_id", LongType()),
    StructField("sale_id", LongType()),
    StructField("method", StringType()),
    StructField("amount", DoubleType()),
])

DIM_DATE = StructType([
    StructField("date_id", IntegerType()),
    StructField("date", DateType()),
    StructField("day", IntegerType()),
    StructField("month", IntegerType()),
    StructField("quarter", IntegerType()),
    StructField("year", IntegerType()),
])

__all__ = ["PRODUCTS", "STORES", "SALES", "SALES_DETAILS", "PAYMENTS", "DIM_DATE",
           "TimestampType", "TimestampNTZType"]
