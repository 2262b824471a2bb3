"""Writing panels, splits, reports and logs.

Partitioned writes rebalance on their partition columns first: small partitions become one file each, and a partition
that holds much of the data is split over several tasks and files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import PANEL_COLUMNS, PERSON, SNAPSHOT, SPLIT
from tidemark.sources.files import scan_partitioned
from tidemark.sources.tables import OrderTables


def write_parts(df: DataFrame, path: str, columns: Sequence[str], keep_others: bool = True) -> None:
    """Replace the partitions present in ``df``; leave all others as they are, or remove them."""
    balanced = df.hint("rebalance", *[F.col(c) for c in columns])
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if keep_others else "static")
    writer.partitionBy(*columns).parquet(path)


def write_panel(panel: DataFrame, path: str) -> None:
    write_parts(panel, path, [SNAPSHOT], keep_others=False)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """A written panel in its original column order, the snapshot as text."""
    stored = scan_partitioned(spark, path)
    first = [c for c in PANEL_COLUMNS if c in stored.columns]
    return stored.select(*first, *[c for c in stored.columns if c not in first])


def write_matrix(matrix: DataFrame, path: str) -> None:
    matrix.write.mode("overwrite").parquet(path)


def write_splits(panel_with_split: DataFrame, path: str) -> None:
    write_parts(panel_with_split, path, [SPLIT], keep_others=False)


def write_features_and_labels(split: DataFrame, features: Sequence[str], label: str, path: str) -> None:
    """Model inputs of all splits: the keys of a row, its features and its label."""
    keys = [c for c in (PERSON, SNAPSHOT) if c in split.columns and c not in features]
    write_parts(split.select(*keys, *features, label, SPLIT), path, [SPLIT], keep_others=False)


def write_report_csv(report: DataFrame, path: str) -> None:
    """CSV in the order of the report, with a header even when it has no rows."""
    report.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_log(scored: DataFrame, path: str) -> None:
    scored.write.mode("overwrite").parquet(path)


def write_checks(checks: DataFrame, path: str) -> None:
    checks.write.mode("overwrite").json(path)


def write_typed(spark: SparkSession, tables: OrderTables, folder: str) -> OrderTables:
    """Store parsed tables and read them back. Their timestamps are real columns, so snapshot filters reach the scan."""
    names = ("orders", "customers", "payments")
    for name in names:
        getattr(tables, name).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    read = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
    return OrderTables(**read, unique_orders=tables.unique_orders, unique_customers=tables.unique_customers)
