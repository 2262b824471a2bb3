"""Point-in-time features of each person who ordered before a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.columns import MONEY, PERSON, SNAPSHOT, STATE
from tidemark.functions.scores import ratio
from tidemark.functions.times import Snapshot, days_between, instant
from tidemark.operators.activity import PAST_MEASURES, activity, merged, summary
from tidemark.sources.tables import OrderTables, orders_before

def feature_columns(snapshot_at: Column, label: Column) -> list[Column]:
    """Feature columns from merged measures and the number of orders in ``frequency``."""
    total = F.col("money").cast("double")
    return [
        F.col(PERSON),
        F.col(STATE),
        days_between(F.col("last_ts"), snapshot_at).alias("recency_days"),
        days_between(F.col("first_ts"), snapshot_at).alias("tenure_days"),
        F.col("frequency"),
        total.alias(MONEY),
        ratio(total, F.col("frequency")).alias("aov"),
        F.col("worst_delay").alias("max_delivery_delay_days"),
        F.col("undelivered").alias("has_undelivered_order"),
        F.col("canceled").alias("total_canceled_orders"),
        label.alias(SNAPSHOT),
    ]


def point_in_time_features(tables: OrderTables, at: Snapshot, strict_as_of: bool = False) -> DataFrame:
    """One row per person with an order before the snapshot.

    With ``strict_as_of`` a delivery on or after the snapshot counts as not yet delivered. Off by default: the final
    delivery date is used, even when it lies after the snapshot.
    """
    past = orders_before(tables.orders, at.at)
    if strict_as_of:
        known = F.col("act_delivery_ts") < instant(at.at)
        past = past.withColumn("act_delivery_ts", F.when(known, F.col("act_delivery_ts")))
    by_state = summary(activity(tables, past), [PERSON], PAST_MEASURES, tables.unique_orders)
    people = (
        by_state.groupBy(PERSON)
        .agg(F.max(STATE).alias(STATE), *merged(PAST_MEASURES), F.sum("frequency").alias("frequency"))
        .filter(F.col("frequency") >= 1)
    )
    return people.select(*feature_columns(instant(at.at), F.lit(at.label)))
