"""Order activity per person, and the measures that summarise it.

Every measure can be merged: the measure of a group is the merge of the measures of its parts. All panel plans
use this, so that rows are summarised before they are shuffled, and one hot person, order or customer id costs each
map task a single row.

The measures are numbers and times only, which Spark merges in a hash table. The largest state of a person is text, which
Spark can only merge by sorting; so the state stays a grouping key until few rows are left (``summary``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.columns import PERSON, STATE
from tidemark.functions.times import days_between
from tidemark.sources.tables import OrderTables

# What counts as a kept order in the target, and what as a cancellation in the features.
COMPLETED_STATUSES = ["delivered", "shipped"]
CANCELED_STATUS = "canceled"

#: Measure and the aggregate that merges it.
PAST_MEASURES = {
    "first_ts": F.min,
    "last_ts": F.max,
    "money": F.sum,
    "worst_delay": F.max,
    "undelivered": F.max,
    "canceled": F.sum,
}
FUTURE_MEASURES = {"came_back": F.max, "future_money": F.sum}
MEASURES = PAST_MEASURES | FUTURE_MEASURES


def order_payments(payments: DataFrame) -> DataFrame:
    """Money per order."""
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("order_payment_value"))


def order_payments_for_hot_ids(payments: DataFrame) -> DataFrame:
    """``order_payments`` for a join with orders whose ids may repeat very often.

    Adaptive execution splits a hot key only where both sides were moved for the join itself, not where one was
    moved for its aggregate. Grouping under a wrapped key keeps the two apart, at the price of moving the sums once more.
    """
    paid = F.sum("payment_value").alias("order_payment_value")
    return payments.groupBy(F.struct("order_id").alias("order")).agg(paid).select("order.order_id", "order_payment_value")


def customer_links(customers: DataFrame, unique: bool = False, by_state: bool = False) -> DataFrame:
    """Which person a customer id belongs to, and how many rows say so.

    A repeated row multiplies money and cancellations of its orders. Counting the copies keeps that result
    without joining each order to every copy. With ``by_state`` copies in different states stay apart, which needs no
    sorting; an order may then meet several rows of one person.
    """
    if unique:
        return customers.select("customer_id", PERSON, STATE, F.lit(1).alias("copies"))
    known = customers.filter(F.col("customer_id").isNotNull())
    copies = F.count(F.lit(1)).alias("copies")
    if by_state:
        return known.groupBy("customer_id", PERSON, STATE).agg(copies)
    return known.groupBy("customer_id", PERSON).agg(F.max(STATE).alias(STATE), copies)


def orders_with_person(
    orders: DataFrame, customers: DataFrame, unique: bool = False, by_state: bool = False
) -> DataFrame:
    """Orders of known customers, with the number of ``copies`` of each link. An order without a customer drops out."""
    return orders.join(customer_links(customers, unique, by_state), "customer_id")


def enriched_orders(tables: OrderTables, orders: DataFrame | None = None) -> DataFrame:
    """Orders with person, state and money. The join on the order id comes last, so that a later grouping by
    order id finds its rows in place."""
    orders = tables.orders if orders is None else orders
    # Rows are counted as orders only where order ids are unique; elsewhere an order may have several rows.
    by_state = not tables.unique_orders
    linked = orders_with_person(orders, tables.customers, tables.unique_customers, by_state)
    paid = (order_payments if tables.unique_orders else order_payments_for_hot_ids)(tables.payments)
    return linked.join(paid, "order_id", "left")


def is_completed() -> Column:
    return F.col("order_status").isin(COMPLETED_STATUSES)


def activity(tables: OrderTables, orders: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of one order and person with all measures, and further columns of the orders to ``keep``. Their number is
    meaningless, their merge is not."""
    paid = F.col("order_payment_value")
    copies = F.col("copies")
    return enriched_orders(tables, orders).select(
        *keep,
        PERSON,
        "order_id",
        "purchase_ts",
        "act_delivery_ts",
        STATE,
        F.col("purchase_ts").alias("first_ts"),
        F.col("purchase_ts").alias("last_ts"),
        (F.coalesce(paid, F.lit(0)) * copies).alias("money"),
        days_between(F.col("est_delivery_ts"), F.col("act_delivery_ts")).alias("worst_delay"),
        F.when(F.col("act_delivery_ts").isNull(), 1).otherwise(0).alias("undelivered"),
        F.when(F.col("order_status") == CANCELED_STATUS, copies).otherwise(0).cast("bigint").alias("canceled"),
        F.when(is_completed() & F.col("order_id").isNotNull(), 1).otherwise(0).alias("came_back"),
        F.when(is_completed(), paid * copies).alias("future_money"),
    )


def merged(measures: dict, when: Column | None = None) -> list[Column]:
    """Aggregates that merge the measures of a group, of the rows where ``when`` holds if given."""
    return [
        how(F.col(name) if when is None else F.when(when, F.col(name))).alias(name)
        for name, how in measures.items()
    ]


def with_frequency(rows: DataFrame, keys: Sequence[str], measures: dict, unique_orders: bool) -> DataFrame:
    """``frequency`` = 1 on the first row of each order within ``(order_id, person)``, else 0.

    Where order ids may repeat, the rows of an order are merged first. They are already partitioned by order id, so
    this moves nothing.
    """
    real = F.col("order_id").isNotNull()
    if unique_orders:
        return rows.withColumn("frequency", real.cast("bigint"))
    rest = [k for k in keys if k != PERSON] + [STATE]
    once = rows.groupBy("order_id", PERSON, *rest).agg(*merged(measures))
    nth = F.row_number().over(Window.partitionBy("order_id", PERSON).orderBy(*rest))
    return once.withColumn("frequency", (real & (nth == 1)).cast("bigint"))


def summary(rows: DataFrame, keys: Sequence[str], measures: dict, unique_orders: bool) -> DataFrame:
    """Merged measures and ``frequency``, the number of different orders, per ``keys`` and state.

    Of all keys but the person, an order is counted under the smallest it has.
    """
    counted = with_frequency(rows, keys, measures, unique_orders)
    return counted.groupBy(*keys, STATE).agg(*merged(measures), F.sum("frequency").alias("frequency"))
