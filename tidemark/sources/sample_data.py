"""Order tables derived from a star schema of orders, customers, nations and line items."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import snapshot
from tidemark.sources.tables import OrderTables, typed_customers, typed_orders, typed_payments

SNAPSHOTS = [snapshot(s) for s in ("1998-01-01", "1998-03-01", "1998-05-01", "1998-07-01")]
DAILY_SNAPSHOTS = [snapshot(date(1997, 7, 1) + timedelta(days=i)) for i in range(365)]
TARGET_DAYS = 180
TRAIN_SNAPSHOTS = ["1998-01-01", "1998-03-01"]
VALIDATION_SNAPSHOT = "1998-05-01"
TEST_SNAPSHOT = "1998-07-01"


# Declared types of the tables a panel is built from. Reading with them asks no file for its schema.
DECLARED = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(DECLARED[name]) if name in DECLARED else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows under their raw names. The last shipping date of an order is its delivery."""
    delivered = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.max("l_shipdate").alias("order_delivered_customer_date"))
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        (F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")).alias("order_estimated_delivery_date"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("canceled")
        .alias("order_status"),
    )
    return orders.join(delivered, "order_id", "left")


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Three customer ids make one person."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.expr("c_custkey div 3").alias("customer_unique_id"),
        F.col("n_name").alias("customer_state"),
    )


def raw_payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per line item, as exact money."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_value"),
    )


def order_tables(spark: SparkSession, folder: str) -> OrderTables:
    return OrderTables(
        typed_orders(raw_orders(spark, folder)),
        typed_customers(raw_customers(spark, folder)),
        typed_payments(raw_payments(spark, folder)),
    )
