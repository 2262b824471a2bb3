"""Tables stored by order id: rows and plans of joins and groupings, with hot and missing ids."""

from pyspark.sql import functions as F

from tests.test_skew import SMALL_SIZES, settings
from tidemark.operators.activity import order_payments, order_payments_for_hot_ids
from tidemark.sources.keyed import join_sums, open_keyed, write_keyed

BUCKETS = 4


def tables(spark):
    """A third of the orders has the id 7, a third of the payments the id 8; some ids are missing, some have no partner."""
    n = F.col("id")
    orders = spark.range(600).select(
        F.when(n % 3 == 0, 7).when(n % 50 == 1, F.lit(None)).otherwise(n).alias("order_id"), (n % 5).alias("odd name")
    )
    payments = spark.range(900).select(
        F.when(n % 3 == 0, 8).when(n % 70 == 1, F.lit(None)).otherwise(n % 700).alias("order_id"), (n % 11).cast("decimal(18,2)").alias("payment_value")
    )
    return orders, payments


def stored(spark, path, orders, payments):
    write_keyed({"orders": orders, "payments": payments}, path, "order_id", BUCKETS)
    return [open_keyed(spark, path, name, "order_id", BUCKETS) for name in ("orders", "payments")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_and_hot_keys(spark, tmp_path):
    raw = tables(spark)
    orders, payments = stored(spark, str(tmp_path / "by-order"), *raw)
    for before, after in zip(raw, (orders, payments), strict=True):
        assert rows(after.all_rows()) == rows(before) and after.all_rows().columns == before.columns
        assert {r[0] for r in after.apart.select("order_id").distinct().collect()} == {7, 8, None}
    joined = join_sums(orders, payments, "order_id", order_payments, order_payments_for_hot_ids)
    assert rows(joined) == rows(raw[0].join(order_payments(raw[1]), "order_id", "left"))
    assert not spark.sql("SHOW TABLES LIKE 'keyed_*'").collect()
    assert len(list(tmp_path.glob("by-order/orders/placed/*.parquet"))) == BUCKETS


def test_no_exchange_where_buckets_meet_and_skew_is_split_beside_them(spark, tmp_path):
    n = F.col("id")
    orders = spark.range(60000).select(F.when(n % 3 == 0, 7).otherwise(n).alias("order_id"), F.hash("id").alias("filling"))
    payments = spark.range(60000).select((n % 20000).alias("order_id"), n.cast("double").alias("payment_value"))
    orders, payments = stored(spark, str(tmp_path / "by-order"), orders, payments)
    with settings(spark, SMALL_SIZES):
        assert "Exchange" not in plan_of(order_payments(payments.placed))
        assert "Exchange" not in plan_of(orders.placed.join(order_payments(payments.placed), "order_id", "left"))
        hot = orders.apart.repartition(8).join(order_payments_for_hot_ids(payments.apart), "order_id", "left")
        hot.collect()
        assert "skew=true" in plan_of(hot)


def test_empty_tables(spark, tmp_path):
    orders, payments = (df.limit(0) for df in tables(spark))
    orders, payments = stored(spark, str(tmp_path / "by-order"), orders, payments)
    assert join_sums(orders, payments, "order_id", order_payments, order_payments_for_hot_ids).count() == 0
