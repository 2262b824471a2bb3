"""Numbering rows in an order without bringing them into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: Spark's increasing ids hold the partition above these bits and the row below.
ROW_BITS = 33


def numbered(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with ``name``, their place from 0 in the order of ``keys``; rows with equal keys follow each other in any order.

    Each range of keys is numbered by its own task and stored; then every range starts where the ranges before it end.
    """
    spark = df.sparkSession
    parts = max(1, spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, "numbered")
    ordered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ordered.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.schema(df.withColumn("__id", F.lit(0).cast("long")).schema).parquet(path)
    stored = stored.withColumn("__part", F.shiftright("__id", ROW_BITS))
    # One row per range, so at most as many as there were partitions.
    sizes = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    row = F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = stored.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__before") + row)
    return placed.select(*df.columns, name)
