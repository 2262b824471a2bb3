"""Projections, filters, joins, aggregates, targets and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered import sql
from registered.registry import query
from registered.sql import with_base
from tidemark.functions import scores, times
from tidemark.operators import activity as act
from tidemark.operators import features as feat
from tidemark.operators import targets as tgt
from tidemark.operators.split import features_of, labels_of
from tidemark.plans import panel as pan
from tidemark.session import scratch_path
from tidemark.sources import keyed
from tidemark.sources import sample_data as data
from tidemark.sources.tables import orders_before

FIRST = data.SNAPSHOTS[0]
LAST = data.SNAPSHOTS[-1]
TS = "TIMESTAMP '1998-01-01 00:00:00'"


def matrix(spark, folder):
    return feat.point_in_time_features(data.order_tables(spark, folder), LAST)


def panel(spark, folder, plan="cells"):
    return pan.build_panel(data.order_tables(spark, folder), data.SNAPSHOTS, data.TARGET_DAYS, plan, stamp=False)


def scored(spark, folder):
    """The matrix with a score any engine computes alike."""
    from tidemark.operators.report import with_revenue_at_risk

    days = F.col("recency_days").cast("double")
    return with_revenue_at_risk(matrix(spark, folder).withColumn("predicted_probability", days / (days + 90.0)))


# --- projections and filters


@query("p1_order_projection", with_base("SELECT * FROM o"))
def order_projection(spark, folder):
    return data.order_tables(spark, folder).orders


@query(
    "p2_as_of_filter",
    with_base(f"SELECT order_id, purchase_ts FROM o WHERE purchase_ts < {TS}"),
)
def as_of_filter(spark, folder):
    return orders_before(data.order_tables(spark, folder).orders, FIRST.at).select("order_id", "purchase_ts")


@query(
    "p3_future_window",
    with_base(
        f"SELECT order_id, purchase_ts FROM o WHERE purchase_ts >= {TS} AND purchase_ts < {TS} + INTERVAL 180 DAY"
    ),
)
def future_window(spark, folder):
    orders = data.order_tables(spark, folder).orders
    return orders.filter(times.in_window(F.col("purchase_ts"), FIRST.at, 180)).select("order_id", "purchase_ts")


@query(
    "p4_completed_orders",
    with_base("SELECT order_id, order_status FROM o WHERE order_status IN ('delivered', 'shipped')"),
)
def completed_orders(spark, folder):
    return data.order_tables(spark, folder).orders.filter(act.is_completed()).select("order_id", "order_status")


@query(
    "p5_snapshot_predicates",
    with_base(
        "SELECT customer_unique_id, snapshot_date FROM panel WHERE snapshot_date IN ('1998-01-01', '1998-03-01') "
        "OR snapshot_date = '1998-07-01'",
        sql.PANEL,
    ),
)
def snapshot_predicates(spark, folder):
    day = F.col("snapshot_date")
    rows = panel(spark, folder).filter(day.isin(data.TRAIN_SNAPSHOTS) | (day == data.TEST_SNAPSHOT))
    return rows.select("customer_unique_id", "snapshot_date")


@query(
    "p7_feature_columns",
    with_base(
        "SELECT customer_state, recency_days, tenure_days, frequency, monetary_total, aov, max_delivery_delay_days, "
        "has_undelivered_order, total_canceled_orders FROM panel",
        sql.PANEL,
    ),
)
def feature_columns(spark, folder):
    return features_of(panel(spark, folder))


@query("p7_label_column", with_base("SELECT target_is_churn FROM panel", sql.PANEL))
def label_column(spark, folder):
    return labels_of(panel(spark, folder))


# --- joins


@query(
    "j1_orders_with_person",
    with_base(
        "SELECT order_id, customer_unique_id, customer_state, purchase_ts FROM o JOIN c USING (customer_id)"
    ),
)
def orders_with_person(spark, folder):
    tables = data.order_tables(spark, folder)
    rows = act.orders_with_person(tables.orders, tables.customers)
    return rows.select("order_id", "customer_unique_id", "customer_state", "purchase_ts")


@query(
    "j2_orders_with_payments",
    with_base(
        "SELECT order_id, CAST(COALESCE(order_payment_value, 0) AS DOUBLE) AS payment_value "
        "FROM o LEFT JOIN opay USING (order_id)"
    ),
)
def orders_with_payments(spark, folder):
    tables = data.order_tables(spark, folder)
    paid = F.coalesce(F.col("order_payment_value"), F.lit(0)).cast("double").alias("payment_value")
    return tables.orders.join(act.order_payments(tables.payments), "order_id", "left").select("order_id", paid)


@query(
    "j2_stored_by_order",
    with_base(
        "SELECT order_id, CAST(COALESCE(order_payment_value, 0) AS DOUBLE) AS payment_value "
        "FROM o LEFT JOIN opay USING (order_id)"
    ),
)
def orders_with_payments_stored_by_order(spark, folder):
    """Orders and payments are stored by order id; the sums and the join move nothing."""
    tables, root = data.order_tables(spark, folder), scratch_path(spark, "by-order")
    keyed.write_keyed({"orders": tables.orders, "payments": tables.payments}, root, "order_id", 16)
    orders, payments = (keyed.open_keyed(spark, root, name, "order_id", 16) for name in ("orders", "payments"))
    rows = keyed.join_sums(orders, payments, "order_id", act.order_payments, act.order_payments_for_hot_ids)
    paid = F.coalesce(F.col("order_payment_value"), F.lit(0)).cast("double").alias("payment_value")
    return rows.select("order_id", paid)


@query("j3_features_targets", with_base(sql.panel_part("1998-01-01")))
def features_with_targets(spark, folder):
    tables = data.order_tables(spark, folder)
    return pan.join_targets(
        feat.point_in_time_features(tables, FIRST), tgt.forward_targets(tables, FIRST, data.TARGET_DAYS)
    )


@query(
    "j4_future_orders_with_person",
    with_base(
        f"SELECT order_id, customer_unique_id FROM o JOIN c USING (customer_id) WHERE order_status IN "
        f"('delivered', 'shipped') AND purchase_ts >= {TS} AND purchase_ts < {TS} + INTERVAL 180 DAY"
    ),
)
def future_orders_with_person(spark, folder):
    tables = data.order_tables(spark, folder)
    future = tgt.future_orders(tables.orders, FIRST, data.TARGET_DAYS)
    return act.orders_with_person(future, tables.customers).select("order_id", "customer_unique_id")


@query(
    "j5_future_money_per_order",
    with_base(
        f"SELECT o.order_id, customer_unique_id, CAST(SUM(payment_value) AS DOUBLE) AS future_money FROM o "
        f"JOIN c USING (customer_id) LEFT JOIN pay ON pay.order_id = o.order_id WHERE order_status IN "
        f"('delivered', 'shipped') AND purchase_ts >= {TS} AND purchase_ts < {TS} + INTERVAL 180 DAY GROUP BY ALL"
    ),
)
def future_money_per_order(spark, folder):
    tables = data.order_tables(spark, folder)
    rows = act.activity(tables, tgt.future_orders(tables.orders, FIRST, data.TARGET_DAYS))
    return rows.select("order_id", "customer_unique_id", F.col("future_money").cast("double").alias("future_money"))


# --- aggregates


@query(
    "a1_order_payments",
    with_base("SELECT order_id, CAST(order_payment_value AS DOUBLE) AS order_payment_value FROM opay"),
)
def order_payments(spark, folder):
    paid = act.order_payments(data.order_tables(spark, folder).payments)
    return paid.withColumn("order_payment_value", F.col("order_payment_value").cast("double"))


@query("a2_rfm_features", with_base(sql.features("1998-01-01")))
def rfm_features(spark, folder):
    return feat.point_in_time_features(data.order_tables(spark, folder), FIRST)


def _people(spark, folder, *columns):
    """Summary of everybody's orders before the first snapshot."""
    tables = data.order_tables(spark, folder)
    rows = act.activity(tables, orders_before(tables.orders, FIRST.at))
    return rows.groupBy("customer_unique_id").agg(*columns)


def _people_sql(columns: str, having: str = "") -> str:
    return with_base(
        f"SELECT customer_unique_id, {columns} FROM o JOIN c USING (customer_id) LEFT JOIN opay USING (order_id) "
        f"WHERE purchase_ts < {TS} GROUP BY customer_unique_id {having}"
    )


@query(
    "a3_extremes",
    _people_sql(
        "MAX(customer_state) AS customer_state, MIN(purchase_ts) AS first_ts, MAX(purchase_ts) AS last_ts, "
        "MAX(DATE_DIFF('day', est_delivery_ts, act_delivery_ts)) AS worst_delay"
    ),
)
def extremes(spark, folder):
    measures = {k: act.PAST_MEASURES[k] for k in ("first_ts", "last_ts", "worst_delay")}
    return _people(spark, folder, F.max("customer_state").alias("customer_state"), *act.merged(measures))


@query("a4_distinct_orders", _people_sql("COUNT(DISTINCT order_id) AS frequency"))
def distinct_orders(spark, folder):
    return _people(spark, folder, F.countDistinct("order_id").alias("frequency"))


@query(
    "a5_conditional_aggregates",
    _people_sql(
        "MAX(CASE WHEN act_delivery_ts IS NULL THEN 1 ELSE 0 END) AS undelivered, "
        "CAST(SUM(CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END) AS BIGINT) AS canceled"
    ),
)
def conditional_aggregates(spark, folder):
    return _people(spark, folder, *act.merged({k: act.PAST_MEASURES[k] for k in ("undelivered", "canceled")}))


@query("a6_active_people", _people_sql("COUNT(DISTINCT order_id) AS frequency", "HAVING COUNT(DISTINCT order_id) >= 1"))
def active_people(spark, folder):
    return feat.point_in_time_features(data.order_tables(spark, folder), FIRST).select(
        "customer_unique_id", "frequency"
    )


@query("a7_forward_targets", with_base(sql.targets("1998-01-01")))
def forward_targets(spark, folder):
    return tgt.forward_targets(data.order_tables(spark, folder), FIRST, data.TARGET_DAYS)


@query(
    "a13_panel_profile",
    with_base(
        "SELECT COUNT(*) AS total_rows, COALESCE(ROUND(AVG(target_is_churn) * 100, 2), 0.0) AS churn_rate_percentage "
        "FROM panel",
        sql.PANEL,
    ),
)
def panel_profile(spark, folder):
    return pan.panel_profile(panel(spark, folder))


@query("a21_scoring_population", with_base("SELECT COUNT(*) AS total_eligible_customers FROM matrix", sql.MATRIX))
def scoring_population(spark, folder):
    return matrix(spark, folder).agg(F.count(F.lit(1)).alias("total_eligible_customers"))


# --- the panel: set operation, chained stages, and all plans

PANEL_SQL = with_base("SELECT * FROM panel", sql.PANEL)


@query("u1_panel_union", PANEL_SQL)
def panel_by_union(spark, folder):
    return panel(spark, folder, "union")


@query("u1_panel_fan_out", PANEL_SQL)
def panel_by_fan_out(spark, folder):
    return panel(spark, folder, "fan_out")


@query("u1_panel_cells", PANEL_SQL)
def panel_by_cells(spark, folder):
    return panel(spark, folder, "cells")


@query("u1_panel_running", PANEL_SQL)
def panel_by_running(spark, folder):
    return panel(spark, folder, "running")


@query("u1_daily_panel", with_base(sql.DAILY_PROFILE))
def daily_panel(spark, folder):
    """A snapshot for each day of a year: rows, people who left, recency and money of the panel by day."""
    tables = data.order_tables(spark, folder)
    rows = pan.build_panel(tables, data.DAILY_SNAPSHOTS, data.TARGET_DAYS, "running", stamp=False)
    return rows.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("people"),
        F.sum("target_is_churn").alias("churned"),
        F.sum("recency_days").alias("recency_days"),
        F.sum("frequency").alias("orders"),
        F.sum(F.col("monetary_total").cast("decimal(18,2)")).cast("double").alias("money"),
        F.sum(F.col("target_180d_ltv").cast("decimal(18,2)")).cast("double").alias("future_money"),
    )


@query("a2_strict_panel", with_base("SELECT * FROM panel", sql.STRICT_PANEL))
def strict_panel(spark, folder):
    """Features from what each snapshot could know of deliveries, all snapshots in one scan of each table."""
    tables = data.order_tables(spark, folder)
    return pan.build_panel(tables, data.SNAPSHOTS, data.TARGET_DAYS, "cells", stamp=False, strict_as_of=True)


@query("u1_panel_cells_unique_ids", PANEL_SQL)
def panel_by_cells_unique(spark, folder):
    """The cheaper plan for ids known to be unique, which they are in these tables (``d8_duplicated_keys``)."""
    tables = data.order_tables(spark, folder).with_proofs(unique_orders=True, unique_customers=True)
    return pan.build_panel(tables, data.SNAPSHOTS, data.TARGET_DAYS, "cells", stamp=False)


@query(
    "q1_enriched_orders",
    with_base(
        f"SELECT customer_unique_id, customer_state, order_id, purchase_ts, est_delivery_ts, act_delivery_ts, "
        f"order_status, CAST(COALESCE(order_payment_value, 0) AS DOUBLE) AS payment_value FROM o "
        f"JOIN c USING (customer_id) LEFT JOIN opay USING (order_id) WHERE purchase_ts < {TS}"
    ),
)
def enriched_orders(spark, folder):
    tables = data.order_tables(spark, folder)
    rows = act.enriched_orders(tables, orders_before(tables.orders, FIRST.at))
    return rows.select(
        "customer_unique_id", "customer_state", "order_id", "purchase_ts", "est_delivery_ts", "act_delivery_ts",
        "order_status", F.coalesce(F.col("order_payment_value"), F.lit(0)).cast("double").alias("payment_value"),
    )


@query("q2_last_snapshot_with_targets", with_base(sql.panel_part("1998-07-01")))
def last_snapshot_with_targets(spark, folder):
    tables = data.order_tables(spark, folder)
    return pan.join_targets(
        feat.point_in_time_features(tables, LAST), tgt.forward_targets(tables, LAST, data.TARGET_DAYS)
    )


# --- scalar functions

# Every order's date as text, in forms that are and are not timestamps.
RAW_TEXT_SQL = """SELECT o_orderkey, CASE o_orderkey % 19
  WHEN 9 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 10 THEN strftime(o_orderdate, '%Y/%m/%d 10:00:00')
  WHEN 11 THEN strftime(o_orderdate, '%Y-%m-%d  10:00:00') WHEN 12 THEN strftime(o_orderdate, '%Y-%m-%d 24:00:00')
  WHEN 13 THEN strftime(o_orderdate, ' %Y-%m-%d') WHEN 14 THEN strftime(o_orderdate, '%Y %m %d')
  WHEN 15 THEN strftime(o_orderdate, '%Y') || chr(92) || strftime(o_orderdate, '%m') || chr(92) || strftime(o_orderdate, '%d')
  WHEN 16 THEN '7' || substr(strftime(o_orderdate, '%Y-%m-%d'), 3) WHEN 17 THEN strftime(o_orderdate, '%Y-%m-%dT 10:00:00 ')
  WHEN 18 THEN 'epoch'
  WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN strftime(o_orderdate, '%Y-%m')
  WHEN 4 THEN strftime(o_orderdate, '%Y') WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '+02:00'
  WHEN 6 THEN '' WHEN 7 THEN strftime(o_orderdate, '%Y-%m') || '-32' ELSE 'unknown' END AS raw FROM orders"""


@query(
    "f1_parse_timestamp",
    f"SELECT o_orderkey, raw, TRY_CAST(raw AS TIMESTAMP) AS parsed, TRY_CAST(raw AS TIMESTAMP) IS NULL AS dropped "
    f"FROM ({RAW_TEXT_SQL})",
)
def parse_timestamp(spark, folder):
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 19
    full = F.date_format(day, "yyyy-MM-dd HH:mm:ss")
    forms = [
        full,
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyy-MM"),
        F.date_format(day, "yyyy"),
        F.concat(full, F.lit("+02:00")),
        F.lit(""),
        F.concat(F.date_format(day, "yyyy-MM"), F.lit("-32")),
        F.lit("unknown"),
        F.date_format(day, "yyyy/MM/dd"),
        F.date_format(day, "yyyy/MM/dd 10:00:00"),
        F.date_format(day, "yyyy-MM-dd  10:00:00"),
        F.date_format(day, "yyyy-MM-dd 24:00:00"),
        F.date_format(day, " yyyy-MM-dd"),
        F.date_format(day, "yyyy MM dd"),
        F.date_format(day, "yyyy\\MM\\dd"),
        F.concat(F.lit("7"), F.substring(F.date_format(day, "yyyy-MM-dd"), 3, 20)),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T 10:00:00 ")),
        F.lit("epoch"),
    ]
    raw = F.coalesce(*[F.when(kind == i, form) for i, form in enumerate(forms)])
    rows = data.table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    parsed = times.parse_timestamp(F.col("raw"))
    return rows.select("*", parsed.alias("parsed"), parsed.isNull().alias("dropped"))


@query(
    "f2_days_between",
    with_base(
        "SELECT order_id, DATE_DIFF('day', est_delivery_ts, act_delivery_ts) AS delay, "
        "DATE_DIFF('day', purchase_ts - INTERVAL 1 SECOND, purchase_ts) AS one_second_before FROM o"
    ),
)
def days_between(spark, folder):
    second = F.expr("INTERVAL '1' SECOND")
    return data.order_tables(spark, folder).orders.select(
        "order_id",
        times.days_between(F.col("est_delivery_ts"), F.col("act_delivery_ts")).alias("delay"),
        times.days_between(F.col("purchase_ts") - second, F.col("purchase_ts")).alias("one_second_before"),
    )


@query(
    "f3_coalesce_money",
    with_base(
        "SELECT order_id, CAST(COALESCE(order_payment_value, 0) AS DOUBLE) AS money, "
        "order_payment_value IS NULL AS unpaid FROM o LEFT JOIN opay USING (order_id)"
    ),
)
def coalesce_money(spark, folder):
    tables = data.order_tables(spark, folder)
    paid = F.col("order_payment_value")
    return tables.orders.join(act.order_payments(tables.payments), "order_id", "left").select(
        "order_id", F.coalesce(paid, F.lit(0)).cast("double").alias("money"), paid.isNull().alias("unpaid")
    )


@query(
    "f4_guarded_ratio",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, "
    "l_extendedprice / NULLIF(l_discount, 0) AS per_discount FROM lineitem",
)
def guarded_ratio(spark, folder):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    rows = data.table(spark, folder, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", price, scores.ratio(price, discount).alias("per_discount"))


@query(
    "f5_case_flags",
    with_base(
        "SELECT order_id, CASE WHEN act_delivery_ts IS NULL THEN 1 ELSE 0 END AS undelivered, "
        "CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END AS canceled FROM o"
    ),
)
def case_flags(spark, folder):
    status = F.col("order_status")
    return data.order_tables(spark, folder).orders.select(
        "order_id",
        F.when(F.col("act_delivery_ts").isNull(), 1).otherwise(0).alias("undelivered"),
        F.when(status == act.CANCELED_STATUS, 1).otherwise(0).alias("canceled"),
    )


@query(
    "f6_window_ends",
    with_base(
        f"SELECT order_id, purchase_ts + INTERVAL 180 DAY AS window_end, {TS} + INTERVAL 180 DAY AS fixed_end FROM o"
    ),
)
def window_ends(spark, folder):
    horizon = F.expr("INTERVAL '180' DAY")
    return data.order_tables(spark, folder).orders.select(
        "order_id", (F.col("purchase_ts") + horizon).alias("window_end"), (times.instant(FIRST.at) + horizon).alias("fixed_end")
    )


@query(
    "f7_ingestion_stamp",
    with_base("SELECT customer_unique_id, snapshot_date, TRUE AS is_recent FROM panel", sql.PANEL),
)
def ingestion_stamp(spark, folder):
    """Each panel row carries the UTC time of the run: within a day of now."""
    rows = pan.stamped(panel(spark, folder))
    age = F.abs(F.unix_seconds(F.col("ingested_at_utc").cast("timestamp")) - F.unix_seconds(F.current_timestamp()))
    return rows.select("customer_unique_id", "snapshot_date", (age < 86400).alias("is_recent"))


@query(
    "f8_integer_counts",
    with_base(
        "SELECT order_status, COUNT(*) AS orders, CAST(SUM(CASE WHEN act_delivery_ts IS NULL THEN 1 ELSE 0 END) "
        "AS BIGINT) AS undelivered FROM o GROUP BY order_status"
    ),
)
def integer_counts(spark, folder):
    missing = F.when(F.col("act_delivery_ts").isNull(), 1).otherwise(0)
    return data.order_tables(spark, folder).orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(missing).cast("bigint").alias("undelivered")
    )


@query(
    "f10_revenue_at_risk",
    with_base("SELECT customer_unique_id, predicted_probability, revenue_at_risk FROM scored", sql.MATRIX, sql.SCORED),
)
def revenue_at_risk(spark, folder):
    return scored(spark, folder).select("customer_unique_id", "predicted_probability", "revenue_at_risk")


@query(
    "f11_rounded_rates",
    with_base(
        "SELECT snapshot_date, ROUND(AVG(target_is_churn) * 100, 2) AS churn_percentage FROM panel "
        "GROUP BY snapshot_date",
        sql.PANEL,
    ),
)
def rounded_rates(spark, folder):
    rate = F.round(F.avg("target_is_churn") * 100, 2).alias("churn_percentage")
    return panel(spark, folder).groupBy("snapshot_date").agg(rate)
