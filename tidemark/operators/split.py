"""Out-of-time splits and what is in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import LABEL, SNAPSHOT, SPLIT, SPLITS, SYSTEM_COLUMNS

def split_by_snapshot(panel: DataFrame, train: Sequence[str], val: str, test: str) -> DataFrame:
    """The panel with its ``split``; rows of other snapshots drop out, and their files are never read."""
    day = F.col(SNAPSHOT)
    name = F.when(day.isin(list(train)), SPLITS[0]).when(day == val, SPLITS[1]).when(day == test, SPLITS[2])
    return panel.filter(day.isin([*train, val, test])).withColumn(SPLIT, name)


def one_split(split_panel: DataFrame, name: str) -> DataFrame:
    return split_panel.filter(F.col(SPLIT) == name).drop(SPLIT)


def feature_names(df: DataFrame, label: str = LABEL) -> list[str]:
    return [c for c in df.columns if c not in SYSTEM_COLUMNS and c not in (label, SPLIT)]


def features_of(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.select(*feature_names(df, label))


def labels_of(df: DataFrame, label: str = LABEL) -> DataFrame:
    if label not in df.columns:
        raise ValueError(f"no label column {label}")
    return df.select(label)


def split_counts(split_panel: DataFrame) -> DataFrame:
    """Rows per split and in total, in one row."""
    counts = [F.count_if(F.col(SPLIT) == s).alias(f"{s}_rows") for s in SPLITS]
    return split_panel.agg(*counts, F.count(F.lit(1)).alias("total_rows"))


def class_balance(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, positives and negatives per positive: rounded to 4 and 1.0 without positives (``imbalance_ratio``), and
    unrounded with at least one positive assumed (``positive_weight``)."""
    counts = train.agg(
        F.count(F.lit(1)).alias("train_rows"), F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias("positives")
    )
    negatives = F.col("train_rows") - F.col("positives")
    share = F.round(negatives / F.nullif(F.col("positives"), F.lit(0)), 4)
    return counts.select(
        "*",
        F.coalesce(share, F.lit(1.0)).alias("imbalance_ratio"),
        (negatives / F.greatest(F.col("positives"), F.lit(1))).alias("positive_weight"),
    )
