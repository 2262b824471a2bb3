"""The panel: features and targets of every person at every snapshot.

Four plans give the same rows.

``union``    one feature and one target query per snapshot. Reads every table twice per snapshot.
``fan_out``  reads every table once and repeats each order for the snapshots it matters to, before it is summarised.
``cells``    reads every table once and summarises first. The snapshots and the ends of their target windows cut
             time into cells; an order lies in one cell, and a person's row for a snapshot merges the cells before it
             (features) and the cells in its window (targets). Only per-person cell summaries are repeated
             per snapshot, never orders, so the large shuffle does not grow with the number of snapshots.
``running``  for long lists of snapshots: the cells of a person are merged along time by window frames, once for each moment at
             which anything changes for them, and only the finished row is repeated up to the next such moment.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.columns import CHURN_TARGET, FEATURE_COLUMNS, INGESTED_AT, PERSON, STATE, VALUE_TARGET
from tidemark.functions.times import Snapshot, instant, utc_now
from tidemark.operators.activity import FUTURE_MEASURES, MEASURES, PAST_MEASURES, activity, merged, summary
from tidemark.operators.features import feature_columns, point_in_time_features
from tidemark.operators.targets import churn_target, forward_targets, value_target
from tidemark.sources.tables import OrderTables, orders_before

def join_targets(features: DataFrame, targets: DataFrame) -> DataFrame:
    """Features with targets. Whoever has no target row has left and brought nothing; so has the person without an
    id, because an unknown id matches nobody."""
    return features.join(targets, PERSON, "left").select(
        *FEATURE_COLUMNS,
        value_target(F.col("future_ltv")).alias(VALUE_TARGET),
        churn_target(F.col("future_orders")).alias(CHURN_TARGET),
    )


def stamped(panel: DataFrame) -> DataFrame:
    return panel.withColumn(INGESTED_AT, utc_now())


def union_panel(
    tables: OrderTables, snapshots: Sequence[Snapshot], days: int, strict_as_of: bool = False
) -> DataFrame:
    parts = [
        join_targets(point_in_time_features(tables, s, strict_as_of), forward_targets(tables, s, days))
        for s in snapshots
    ]
    return reduce(DataFrame.unionByName, parts)


def _literals(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _snapshot_rows(merged_rows: DataFrame, snapshots: Sequence[Snapshot]) -> DataFrame:
    """Panel columns from one merged row per person and snapshot number."""
    number = F.col("snapshot")
    moments = F.array(*[instant(s.at) for s in snapshots])
    known = F.col(PERSON).isNotNull()
    money = F.when(known, F.col("future_money").cast("double"))
    return merged_rows.filter(F.col("frequency") >= 1).select(
        *feature_columns(moments[number], _literals([s.label for s in snapshots])[number]),
        value_target(money).alias(VALUE_TARGET),
        churn_target(F.when(known, F.col("came_back"))).alias(CHURN_TARGET),
    )


def fan_out_panel(tables: OrderTables, snapshots: Sequence[Snapshot], days: int) -> DataFrame:
    last = max(s.window_end(days) for s in snapshots)
    bought = F.col("purchase_ts")
    # 1 = before the snapshot, 0 = in its target window, NULL = neither
    roles = F.array(
        *[
            F.when(bought < instant(s.at), 1).when(bought < instant(s.window_end(days)), 0)
            for s in snapshots
        ]
    )
    rows = (
        activity(tables, orders_before(tables.orders, last))
        .select("*", F.posexplode(roles).alias("snapshot", "role"))
        .filter(F.col("role").isNotNull())
    )
    past, future = F.col("role") == 1, F.col("role") == 0
    count = F.count if tables.unique_orders else F.countDistinct
    people = rows.groupBy(PERSON, "snapshot").agg(
        F.max(F.when(past, F.col(STATE))).alias(STATE),
        *merged(PAST_MEASURES, past),
        *merged(FUTURE_MEASURES, future),
        count(F.when(past, F.col("order_id"))).alias("frequency"),
    )
    return _snapshot_rows(people, snapshots)


def cut_points(snapshots: Sequence[Snapshot], days: int) -> list[datetime]:
    """Instants where the role of an order changes for some snapshot."""
    return sorted({s.at for s in snapshots} | {s.window_end(days) for s in snapshots})


def cell_of(moment: Column, cuts: Sequence[datetime]) -> Column:
    """Number of cut points at or before ``moment``, found by halving."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(moment < instant(cuts[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return between(0, len(cuts))


def cell_summary(tables: OrderTables, cuts: Sequence[datetime], strict_as_of: bool = False) -> DataFrame:
    """Merged measures per person, cell and state. With ``strict_as_of`` a cell has a second side, ``told``: the cell of the
    delivery, from which on it is known."""
    rows = activity(tables, orders_before(tables.orders, cuts[-1]))
    rows = rows.withColumn("cell", cell_of(F.col("purchase_ts"), cuts))
    keys = [PERSON, "cell"]
    if strict_as_of:
        never = F.lit(len(cuts) + 1)
        delivered = F.col("act_delivery_ts")
        rows = rows.withColumn("told", F.when(delivered.isNull(), never).otherwise(cell_of(delivered, cuts)))
        keys.append("told")
    return summary(rows, keys, MEASURES, tables.unique_orders)


def cells_panel(tables: OrderTables, snapshots: Sequence[Snapshot], days: int, strict_as_of: bool = False) -> DataFrame:
    """The ``cells`` plan. With ``strict_as_of`` a snapshot takes the delivery measures only of cells whose delivery lies
    before it."""
    snapshots = sorted(snapshots, key=lambda s: s.at)
    cuts = cut_points(snapshots, days)
    starts = [cuts.index(s.at) for s in snapshots]
    ends = [cuts.index(s.window_end(days)) for s in snapshots]

    by_cell = cell_summary(tables, cuts, strict_as_of)
    # A cell matters to the snapshots from the first whose window reaches it. The few cells of a person are brought
    # together before they are repeated per snapshot, so what is shuffled does not grow with the snapshots.
    first = _literals([min(n for n, end in enumerate(ends) if cell <= end) for cell in range(len(cuts))])
    number = F.explode(F.sequence(first[F.col("cell")], F.lit(len(snapshots) - 1)))
    spread = by_cell.repartition(PERSON).withColumn("snapshot", number)
    start = _literals(starts)[F.col("snapshot")]
    past = F.col("cell") <= start
    if strict_as_of:
        known = F.col("told") <= start
        spread = spread.withColumns(
            {"worst_delay": F.when(known, F.col("worst_delay")), "undelivered": F.when(known, 0).otherwise(1)}
        )
    people = spread.groupBy(PERSON, "snapshot").agg(
        F.max(F.when(past, F.col(STATE))).alias(STATE),
        *merged(PAST_MEASURES, past),
        *merged(FUTURE_MEASURES, ~past),
        F.coalesce(F.sum(F.when(past, F.col("frequency"))), F.lit(0)).alias("frequency"),
    )
    return _snapshot_rows(people, snapshots)


def microseconds(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def running_panel(tables: OrderTables, snapshots: Sequence[Snapshot], days: int, strict_as_of: bool = False) -> DataFrame:
    """The ``running`` plan.

    Each cell of a person becomes a few rows on the time line: at the first snapshot that has it in its target window, at its
    own place in that window, at the first snapshot that has it in the past and, with ``strict_as_of``, at the first one that
    knows of its delivery. Nothing changes for the person at other snapshots. A frame from the beginning to the row merges the
    past, a frame of ``days`` from the row on merges the target window; nothing is subtracted, so money keeps its exact sum.
    The finished row is then repeated for the snapshots up to the next change. After the one exchange by person there are at
    most four rows a cell, whatever the number of snapshots, besides the rows of the result.
    """
    snapshots = sorted(snapshots, key=lambda s: s.at)
    cuts = cut_points(snapshots, days)
    starts = [cuts.index(s.at) for s in snapshots]
    ends = [cuts.index(s.window_end(days)) for s in snapshots]
    beyond = len(snapshots)
    places = [microseconds(cut - datetime(1970, 1, 1)) for cut in cuts]

    def first_reaching(bounds: Sequence[int]) -> Column:
        """By cell, the number of the first snapshot whose bound is not before it."""
        return _literals([bisect_left(bounds, cell) for cell in range(len(cuts) + 2)])

    cell = F.col("cell")
    enters, leaves = first_reaching(ends)[cell], first_reaching(starts)[cell]
    known = F.greatest(leaves, first_reaching(starts)[F.col("told")]) if strict_as_of else leaves
    at = _literals([places[start] for start in starts])

    def event(number: Column, past: Column | bool = False, tells: Column | bool = False) -> Column:
        named = {"time": F.get(at, number), "number": number, "past": past, "tells": tells, "ahead": False}
        return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in named.items()])

    # The target window of a snapshot begins with the snapshot itself; cell n lies between the cuts n - 1 and n.
    in_target = F.struct(
        F.get(_literals(places), cell - 1).alias("time"), F.lit(None).cast("int").alias("number"),
        F.lit(False).alias("past"), F.lit(False).alias("tells"), F.lit(True).alias("ahead"),
    )
    brings = (enters < leaves) & ((F.col("came_back") > 0) | F.col("future_money").isNotNull())
    events = F.array(
        F.when(leaves < beyond, event(leaves, True, known == leaves)),
        F.when((known > leaves) & (known < beyond), event(known, False, True)),
        F.when(brings, event(enters)),
        F.when(brings, in_target),
    )
    rows = cell_summary(tables, cuts, strict_as_of).repartition(PERSON)
    rows = rows.withColumn("event", F.explode(F.array_compact(events))).select("*", "event.*")

    line = Window.partitionBy(PERSON).orderBy("time")
    so_far = line.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    window = line.rangeBetween(0, microseconds(timedelta(days=days)) - 1)
    past, tells = F.col("past"), F.col("tells")
    measures = dict(PAST_MEASURES)
    del measures["worst_delay"], measures["undelivered"]
    open_orders = F.sum(past.cast("int") - tells.cast("int")).over(so_far)
    undelivered = F.max(F.when(past, F.col("undelivered"))).over(so_far)
    merged_rows = rows.select(
        PERSON,
        "number",
        "time",
        F.max(F.when(past, F.col(STATE))).over(so_far).alias(STATE),
        *[how(F.when(past, F.col(name))).over(so_far).alias(name) for name, how in measures.items()],
        F.max(F.when(tells, F.col("worst_delay"))).over(so_far).alias("worst_delay"),
        (F.when(open_orders > 0, 1).otherwise(0) if strict_as_of else undelivered).alias("undelivered"),
        F.sum(F.when(past, F.col("frequency"))).over(so_far).alias("frequency"),
        *[how(F.when(F.col("ahead"), F.col(name))).over(window).alias(name) for name, how in FUTURE_MEASURES.items()],
    )
    # Rows of one moment are alike; the last of them is followed by a later snapshot and fills the gap.
    changes = merged_rows.filter(F.col("number").isNotNull()).withColumn("next", F.lead("number", 1, beyond).over(line))
    changes = changes.filter((F.col("next") > F.col("number")) & (F.col("frequency") >= 1))
    filled = changes.withColumn("snapshot", F.explode(F.sequence("number", F.col("next") - 1)))
    return _snapshot_rows(filled, snapshots)


PLANS = {"union": union_panel, "fan_out": fan_out_panel, "cells": cells_panel, "running": running_panel}


def build_panel(
    tables: OrderTables,
    snapshots: Sequence[Snapshot],
    days: int = 180,
    plan: str = "cells",
    stamp: bool = True,
    strict_as_of: bool = False,
) -> DataFrame:
    """One row per snapshot and person who ordered before it.

    ``strict_as_of`` hides deliveries after each snapshot. What an order adds then differs from snapshot to snapshot, which
    the ``union`` plan follows with a query per snapshot, ``cells`` and ``running`` with one scan.
    """
    if strict_as_of and plan == "fan_out":
        raise ValueError("strict_as_of needs plan='cells', 'running' or 'union'")
    if strict_as_of:
        panel = PLANS[plan](tables, snapshots, days, strict_as_of=True)
    else:
        panel = PLANS[plan](tables, snapshots, days)
    return stamped(panel) if stamp else panel


def panel_profile(panel: DataFrame) -> DataFrame:
    """Rows and churn percentage of a panel, 0.0 for an empty one."""
    churn = F.round(F.avg(CHURN_TARGET) * 100, 2)
    return panel.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(churn, F.lit(0.0)).alias("churn_rate_percentage"),
    )
