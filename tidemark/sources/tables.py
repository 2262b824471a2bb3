"""The three tables a panel is built from, in one typed shape whatever they were read from."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import as_timestamp, instant

# Raw column names and the names used here.
ORDER_TIMES = {
    "order_purchase_timestamp": "purchase_ts",
    "order_estimated_delivery_date": "est_delivery_ts",
    "order_delivered_customer_date": "act_delivery_ts",
}


@dataclass(frozen=True)
class OrderTables:
    """Orders, customers and payments, typed.

    ``unique_orders`` and ``unique_customers`` say that order ids and customer ids are known to be unique, which
    the quality job proves. They never change a result on data that keeps the promise; they only allow a
    cheaper plan.
    """

    orders: DataFrame
    customers: DataFrame
    payments: DataFrame
    unique_orders: bool = False
    unique_customers: bool = False

    def with_proofs(self, unique_orders: bool, unique_customers: bool) -> "OrderTables":
        return replace(self, unique_orders=unique_orders, unique_customers=unique_customers)


def typed_orders(raw: DataFrame) -> DataFrame:
    """Order facts with parsed timestamps. Partition columns, if any, are kept for pruning."""
    kept = [c for c in ("year", "month", "day") if c in raw.columns]
    return raw.select(
        "order_id",
        "customer_id",
        *[as_timestamp(raw, old).alias(new) for old, new in ORDER_TIMES.items()],
        "order_status",
        *kept,
    )


def typed_customers(raw: DataFrame) -> DataFrame:
    return raw.select("customer_id", "customer_unique_id", "customer_state")


def typed_payments(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", "payment_value")


def typed_tables(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> OrderTables:
    """Parse once. Text timestamps cannot be pushed into a scan, typed ones can: write the result and read it back
    when it will be used more than once (``sinks.write_typed``)."""
    return OrderTables(typed_orders(orders), typed_customers(customers), typed_payments(payments))


def orders_before(orders: DataFrame, cutoff) -> DataFrame:
    """Orders bought strictly before ``cutoff``; rows without a readable purchase time drop out."""
    return orders.filter(F.col("purchase_ts") < instant(cutoff))
