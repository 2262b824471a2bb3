"""What each person did in the days after a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.columns import PERSON
from tidemark.functions.times import Snapshot, in_window
from tidemark.operators.activity import activity, is_completed
from tidemark.sources.tables import OrderTables


def future_orders(orders: DataFrame, at: Snapshot, days: int) -> DataFrame:
    """Completed orders in ``[snapshot, snapshot + days)``."""
    return orders.filter(is_completed() & in_window(F.col("purchase_ts"), at.at, days))


def forward_targets(tables: OrderTables, at: Snapshot, days: int) -> DataFrame:
    """Number and value of each person's completed orders after the snapshot; the value is NULL if none was paid.

    Payments are summed per order before the join. That gives the money of the raw payment rows without
    joining each order to every payment.
    """
    rows = activity(tables, future_orders(tables.orders, at, days))
    count = F.count if tables.unique_orders else F.countDistinct
    return rows.groupBy(PERSON).agg(
        count("order_id").alias("future_orders"),
        F.sum("future_money").cast("double").alias("future_ltv"),
    )


def value_target(future_money: Column) -> Column:
    return F.coalesce(future_money, F.lit(0.0))


def churn_target(future_orders: Column) -> Column:
    return F.when(F.coalesce(future_orders, F.lit(0)) > 0, 0).otherwise(1)
