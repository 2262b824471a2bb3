"""Sizes and ranges of stored tables from the footers of their Parquet files; no column is read where footers know it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, NumericType

V1_SOURCES = "spark.sql.sources.useV1SourceList"
PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def footer_aggregates(spark: SparkSession) -> Iterator[None]:
    """Counts and ranges of Parquet tables opened and computed inside come from footers."""
    before = {key: spark.conf.get(key) for key in (V1_SOURCES, PUSHDOWN)}
    spark.conf.set(V1_SOURCES, ",".join(s for s in before[V1_SOURCES].split(",") if s != "parquet"))
    spark.conf.set(PUSHDOWN, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def in_footers(kind) -> bool:
    """Types whose ranges footers hold exactly. Text may be cut there, and doubles leave NaN out."""
    return isinstance(kind, (NumericType, DateType)) and not isinstance(kind, (DoubleType, FloatType))


def summary_row(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of rows, and of each column values that are there, smallest and largest."""
    wanted = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(columns):
        column = F.col(f"`{name}`")
        wanted += [F.count(column).alias(f"n{i}"), F.min(column).alias(f"min{i}"), F.max(column).alias(f"max{i}")]
    return rows.agg(*wanted)


def from_footers(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> Row:
    """``summary_row`` of a table from its footers. Where a file lacks statistics, its columns are read instead."""
    with footer_aggregates(spark):
        try:
            return summary_row(spark.read.parquet(path), columns).first()
        except (PySparkException, Py4JJavaError) as error:
            if PUSHDOWN not in str(error):
                raise
    return summary_row(spark.read.parquet(path), columns).first()


def column_ranges(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column of a stored table: column_name, n_rows, n_values (not null), smallest and largest as text.

    Counts, whole numbers, decimals and dates come from footers. Other columns are read, in one pass over these alone. A
    table without rows has null ranges.
    """
    kinds = {f.name: f.dataType for f in spark.read.parquet(path).schema}
    columns = list(kinds) if columns is None else list(columns)
    known = [c for c in columns if in_footers(kinds[c])]
    rest = [c for c in columns if c not in known]
    out = {}
    for names, row in ((known, from_footers(spark, path, known)), (rest, summary_row(spark.read.parquet(path), rest).first() if rest else None)):
        for i, name in enumerate(names):
            low, high = row[f"min{i}"], row[f"max{i}"]
            out[name] = (name, row["n"], row[f"n{i}"], None if low is None else str(low), None if high is None else str(high))
    schema = "column_name string, n_rows long, n_values long, smallest string, largest string"
    return spark.createDataFrame([out[c] for c in columns], schema)


def stored_size(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a stored table, from its footers, and bytes of its Parquet files, from their listing, rows or not."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    total = F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    return listed.agg(total).select(F.lit(from_footers(spark, path)["n"]).cast("long").alias("total_rows"), "total_bytes")
