"""A third of all rows under one key: the plan splits them and the rows stay the same."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tests.test_features import SNAPSHOTS, rows_of
from tidemark.operators.quality import duplicated_keys
from tidemark.plans.panel import build_panel
from tidemark.sources import files, sinks
from tidemark.sources.tables import OrderTables

SMALL_SIZES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    # A partition is split between the outputs of map tasks, so there must be several.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark, hot_column, path):
    """Orders of which every third has the same customer id, order id or person."""
    n = F.col("id")
    hot = n % 3 == 0
    customer = F.when(hot, F.lit(0)).otherwise(n % 500) if hot_column == "customer_id" else n % 500
    order_id = F.when(hot, F.lit(0)).otherwise(n) if hot_column == "order_id" else n
    orders = spark.range(0, 30_000, numPartitions=8).select(
        order_id.cast("string").alias("order_id"),
        customer.cast("string").alias("customer_id"),
        (F.lit("2017-03-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(n % 500)).alias("purchase_ts"),
        (F.lit("2017-04-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(n % 500)).alias("est_delivery_ts"),
        (F.lit("2017-03-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(n % 541)).alias("act_delivery_ts"),
        F.when(n % 17 == 0, "canceled").otherwise("delivered").alias("order_status"),
    )
    person = F.when(n % 3 == 0, F.lit(None)).otherwise(n % 100) if hot_column == "person" else n % 100
    customers = spark.range(500).select(
        n.cast("string").alias("customer_id"), person.cast("string").alias("customer_unique_id"),
        F.concat(F.lit("S"), n % 27).alias("customer_state"),
    )
    payments = spark.range(0, 60_000, numPartitions=8).select(
        F.when(hot, F.lit(0)).otherwise(n % 30_000).cast("string").alias("order_id"),
        (n % 90).cast("decimal(18,2)").alias("payment_value"),
    )
    return sinks.write_typed(spark, OrderTables(orders, customers, payments), str(path))


@pytest.mark.parametrize("hot", ["customer_id", "order_id", "person"])
def test_hot_keys_give_the_same_panel(spark, tmp_path, hot):
    tables = skewed(spark, hot, tmp_path)
    expected = rows_of(build_panel(tables, SNAPSHOTS, plan="union", stamp=False))
    with settings(spark, SMALL_SIZES):
        panel = build_panel(tables, SNAPSHOTS, stamp=False)
        assert rows_of(panel) == expected
        plan = panel._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    if hot != "person":  # a hot person never reaches a join
        assert "skew=true" in plan
    assert len(expected) >= 4 * 66


def test_a_hot_partition_is_written_as_several_files(spark, tmp_path):
    rows = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("part"),
    )
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB"}):
        sinks.write_parts(rows, str(tmp_path / "t"), ["part"])
    assert len(list((tmp_path / "t" / "part=hot").glob("*.parquet"))) > 1
    read = files.scan_partitioned(spark, str(tmp_path / "t"))
    assert read.count() == 60_000 and read.select("id").distinct().count() == 60_000


def test_copies_are_counted_before_they_move(spark, tmp_path):
    spark.range(0, 100_000, numPartitions=8).select((F.col("id") % 2).alias("k")).write.parquet(str(tmp_path / "t"))
    found = duplicated_keys(spark.read.parquet(str(tmp_path / "t")), "k")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    rows = [float(x) for x in re.findall(r"ShuffleQueryStage.*?\n", plan) for x in re.findall(r"rowCount=([\d.E+]+)", x)]
    partial = plan.index("Exchange")
    assert "HashAggregate" in plan[partial:] and all(r <= 64 for r in rows)
