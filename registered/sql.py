"""SQL over the given tables: the building blocks of all checks."""

SNAPSHOTS = ("1998-01-01", "1998-03-01", "1998-05-01", "1998-07-01")

# Orders, customers and payments.
BASE = """
o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS purchase_ts,
         o_orderdate + INTERVAL 30 DAY AS est_delivery_ts, shipped_at AS act_delivery_ts,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status
  FROM orders LEFT JOIN (SELECT l_orderkey, MAX(l_shipdate) AS shipped_at FROM lineitem GROUP BY l_orderkey) s
       ON s.l_orderkey = o_orderkey),
c AS (
  SELECT c_custkey AS customer_id, c_custkey // 3 AS customer_unique_id, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
pay AS (SELECT l_orderkey AS order_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_value FROM lineitem),
opay AS (SELECT order_id, SUM(payment_value) AS order_payment_value FROM pay GROUP BY order_id)"""


def with_base(query: str, *more: str) -> str:
    return "WITH " + ", ".join([BASE.strip(), *more]) + "\n" + query


def features(at: str) -> str:
    ts = f"TIMESTAMP '{at} 00:00:00'"
    return f"""
  SELECT customer_unique_id, MAX(customer_state) AS customer_state,
         DATE_DIFF('day', MAX(purchase_ts), {ts}) AS recency_days,
         DATE_DIFF('day', MIN(purchase_ts), {ts}) AS tenure_days,
         COUNT(DISTINCT order_id) AS frequency,
         CAST(SUM(COALESCE(order_payment_value, 0)) AS DOUBLE) AS monetary_total,
         CAST(SUM(COALESCE(order_payment_value, 0)) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0) AS aov,
         MAX(DATE_DIFF('day', est_delivery_ts, act_delivery_ts)) AS max_delivery_delay_days,
         MAX(CASE WHEN act_delivery_ts IS NULL THEN 1 ELSE 0 END) AS has_undelivered_order,
         CAST(SUM(CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END) AS BIGINT) AS total_canceled_orders,
         '{at}' AS snapshot_date
  FROM o JOIN c USING (customer_id) LEFT JOIN opay USING (order_id)
  WHERE purchase_ts < {ts}
  GROUP BY customer_unique_id HAVING COUNT(DISTINCT order_id) >= 1"""


def targets(at: str, days: int = 180) -> str:
    ts = f"TIMESTAMP '{at} 00:00:00'"
    return f"""
  SELECT customer_unique_id, COUNT(DISTINCT o.order_id) AS future_orders,
         CAST(SUM(payment_value) AS DOUBLE) AS future_ltv
  FROM o JOIN c USING (customer_id) LEFT JOIN pay ON pay.order_id = o.order_id
  WHERE order_status IN ('delivered', 'shipped')
    AND purchase_ts >= {ts} AND purchase_ts < {ts} + INTERVAL {days} DAY
  GROUP BY customer_unique_id"""


def panel_part(at: str) -> str:
    return f"""
  SELECT f.*, COALESCE(t.future_ltv, 0.0) AS target_180d_ltv,
         CASE WHEN COALESCE(t.future_orders, 0) > 0 THEN 0 ELSE 1 END AS target_is_churn
  FROM ({features(at)}) f LEFT JOIN ({targets(at)}) t USING (customer_unique_id)"""


PANEL = "panel AS (" + " UNION ALL ".join(panel_part(s) for s in SNAPSHOTS) + ")"
SPLIT = """split AS (
  SELECT *, CASE WHEN snapshot_date IN ('1998-01-01', '1998-03-01') THEN 'train'
                 WHEN snapshot_date = '1998-05-01' THEN 'val' ELSE 'test' END AS split
  FROM panel)"""
# The panel without deliveries that a snapshot cannot know yet.
_KNOWN = "CASE WHEN act_delivery_ts < TIMESTAMP '{at} 00:00:00' THEN act_delivery_ts END"
STRICT_PANEL = "panel AS (" + " UNION ALL ".join(
    panel_part(s).replace("act_delivery_ts", _KNOWN.format(at=s)) for s in SNAPSHOTS
) + ")"
# The panel of each day of a year, by day.
DAILY_PROFILE = """
, days AS (SELECT CAST(d AS TIMESTAMP) AS moment FROM range(DATE '1997-07-01', DATE '1998-07-01', INTERVAL 1 DAY) r(d)),
per_order AS (
  SELECT customer_unique_id, order_id, purchase_ts, order_status, order_payment_value
  FROM o JOIN c USING (customer_id) LEFT JOIN opay USING (order_id)),
history AS (
  SELECT customer_unique_id, moment, DATE_DIFF('day', MAX(purchase_ts), moment) AS recency_days, COUNT(DISTINCT order_id) AS orders,
         SUM(COALESCE(order_payment_value, 0)) AS money
  FROM per_order JOIN days ON purchase_ts < moment GROUP BY customer_unique_id, moment),
future AS (
  SELECT customer_unique_id, moment, SUM(order_payment_value) AS future_money
  FROM per_order JOIN days ON purchase_ts >= moment AND purchase_ts < moment + INTERVAL 180 DAY
  WHERE order_status IN ('delivered', 'shipped') GROUP BY customer_unique_id, moment)
SELECT STRFTIME(moment, '%Y-%m-%d') AS snapshot_date, COUNT(*) AS people,
       COUNT(*) FILTER (WHERE f.moment IS NULL) AS churned, CAST(SUM(recency_days) AS BIGINT) AS recency_days,
       CAST(SUM(orders) AS BIGINT) AS orders, CAST(SUM(money) AS DOUBLE) AS money,
       CAST(SUM(COALESCE(future_money, 0)) AS DOUBLE) AS future_money
FROM history h LEFT JOIN future f USING (customer_unique_id, moment) GROUP BY moment"""
MATRIX = f"matrix AS ({features('1998-07-01')})"

# A score any engine computes alike.
PROBABILITY = "CAST(recency_days AS DOUBLE) / (CAST(recency_days AS DOUBLE) + 90e0)"
SCORED = f"""scored AS (
  SELECT *, {PROBABILITY} AS predicted_probability, {PROBABILITY} * monetary_total AS revenue_at_risk FROM matrix)"""
# Predictions of two models on the test split.
PREDICTIONS = f"""predictions AS (
  SELECT 'challenger' AS model_id, target_is_churn AS y, {PROBABILITY} AS p, monetary_total
  FROM panel WHERE snapshot_date = '1998-07-01'
  UNION ALL
  SELECT 'champion', target_is_churn, CAST(recency_days AS DOUBLE) / (CAST(recency_days AS DOUBLE) + 400e0),
         monetary_total
  FROM panel WHERE snapshot_date = '1998-07-01')"""
EVALUATION = """cut AS (SELECT quantile_cont(monetary_total, 0.9) AS q90 FROM predictions),
evaluation AS (
  SELECT model_id, COUNT(*) AS test_set_size,
         AVG(CASE WHEN y = 1 THEN -LN(GREATEST(LEAST(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16))
                  ELSE -LN(1 - GREATEST(LEAST(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16)) END) AS log_loss,
         AVG((p - y) * (p - y)) AS brier_score,
         COALESCE(AVG(CASE WHEN monetary_total >= q90 THEN (p - y) * (p - y) END), AVG((p - y) * (p - y)))
           AS high_value_slice_brier_score,
         COUNT(*) FILTER (WHERE p * 500e0 * 0.1e0 - 10e0 > 0) AS contacted,
         CAST(COALESCE(SUM(y) FILTER (WHERE p * 500e0 * 0.1e0 - 10e0 > 0), 0) AS BIGINT) AS contacted_churners
  FROM predictions, cut GROUP BY model_id),
metrics AS (
  SELECT *, CASE WHEN contacted > 0 THEN (contacted_churners * 50e0 - contacted * 10e0) / (contacted * 10e0)
                 ELSE 0e0 END AS eroi
  FROM evaluation)"""
