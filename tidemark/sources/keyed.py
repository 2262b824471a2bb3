"""Tables stored by a key, so that joins and groupings by it move nothing.

Tables of one layout are bucketed alike. A key that holds more than a bucket should is kept apart, with the rows without a
key: a bucket is one task, and no later plan can split it. The few such rows of all tables lie beside the buckets and are
joined with an exchange, which adaptive execution splits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.files import hadoop_path

#: Share of a bucket's fair amount from which a key is kept apart. At most buckets / HOT_SHARE keys a table can reach it.
HOT_SHARE = 0.5


@contextmanager
def table_name(spark: SparkSession) -> Iterator[str]:
    """A name in the session catalog, only while a bucketed folder is written or opened. Files stay when it goes."""
    name = f"keyed_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """One file per bucket if the rows of a task lie in one bucket, as after ``repartition(buckets, key)``."""
    with table_name(df.sparkSession) as name:
        df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def open_buckets(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = hadoop_path(spark, path).toString().replace("'", "\\'")
    with table_name(spark) as name:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
        return spark.table(name)


@dataclass(frozen=True)
class Keyed:
    """A stored table: ``placed`` by buckets, and the ``apart`` rows of hot and missing keys."""

    placed: DataFrame
    apart: DataFrame

    def all_rows(self) -> DataFrame:
        return self.placed.unionByName(self.apart)


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Keys with at least HOT_SHARE of the rows of an even bucket."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    whole = df.agg(F.count(F.lit(1)).alias("whole"))
    return counts.join(F.broadcast(whole), F.col("n") * buckets >= F.col("whole") * HOT_SHARE).filter("n > 1").select(key)


def write_keyed(tables: dict[str, DataFrame], root: str, key: str, buckets: int) -> None:
    """Store tables by a key they share. Each is read twice: to count its keys, and to write it.

    A key that is hot in one table is apart in all, so that what belongs together meets.
    """
    spark = next(iter(tables.values())).sparkSession
    found = None
    for df in tables.values():
        keys = hot_keys(df, key, buckets)
        found = keys if found is None else found.union(keys)
    found.distinct().write.parquet(f"{root}/hot")
    hot = spark.read.parquet(f"{root}/hot")  # at most buckets / HOT_SHARE rows for each table
    for name, df in tables.items():
        write_buckets(
            df.filter(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti").select(df.columns).repartition(buckets, key),
            f"{root}/{name}/placed",
            key,
            buckets,
        )
        apart = df.filter(F.col(key).isNull()).unionByName(df.join(F.broadcast(hot), key, "left_semi").select(df.columns))
        apart.write.parquet(f"{root}/{name}/apart")


def open_keyed(spark: SparkSession, root: str, name: str, key: str, buckets: int) -> Keyed:
    """A stored table; ``buckets`` is the number it was written with."""
    apart = spark.read.parquet(f"{root}/{name}/apart")
    return Keyed(open_buckets(spark, f"{root}/{name}/placed", apart.schema, key, buckets), apart)


def join_sums(left: Keyed, right: Keyed, key: str, sums: Callable[[DataFrame], DataFrame], hot_sums: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Left join of all rows with sums of the right table by the key: in place by buckets, ``hot_sums`` for what is apart."""
    placed = left.placed.join(sums(right.placed), key, "left")
    return placed.unionByName(left.apart.join(hot_sums(right.apart), key, "left"))
