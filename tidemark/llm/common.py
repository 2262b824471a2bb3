"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import apply_settings, scratch_path

#: Words everywhere in this folder: runs of characters other than these six blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: Physical limits of one Arrow batch, so that very long texts do not meet in one Python object.
BATCH_ROWS = 1000
BATCH_BYTES = 16 * 1024 * 1024

#: Most bits of a bitmap of key hashes (8 MB), of which each key has ``BITS_PER_KEY`` as long as they last.
MOST_BITS, BITS_PER_KEY = 1 << 26, 32


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the text operators rely on: small Arrow batches, splitting of skewed joins, and Python workers that
    find this package where the driver has it (elsewhere it has to be installed)."""
    apply_settings(spark)
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def parted(df: DataFrame, columns: list[str], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``columns`` are surely not in ``keys``, and those where they may be.

    So only the second part has to be joined, and wide rows are not sent around for the sake of a few keys. ``keys`` is a stored
    table of columns in the same order and of the same types. A bitmap of their hashes decides; its size is bounded, so with very
    many keys the second part grows, up to all of ``df``. Both parts read ``df``.
    """
    size = min(MOST_BITS, max(1 << 15, 1 << (BITS_PER_KEY * keys.count()).bit_length()))
    part, bits = unused(df, "bitmap_part"), unused(df, "bitmap_bits")

    def place(names: list[str]) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(size)) + 1

    held = keys.select(place(keys.columns).alias("place")).groupBy(F.bitmap_bucket_number("place").alias(part))
    bitmap = stored(held.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias(bits)), "bitmap")
    own = F.bitmap_bit_position(place(columns)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(own, 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.call_function("getbit", byte, own.bitwiseAND(7)) == 1, F.lit(False))
    marked = df.join(F.broadcast(bitmap), F.bitmap_bucket_number(place(columns)) == F.col(part), "left")
    return marked.where(~found).drop(part, bits), marked.where(found).drop(part, bits)


def map_columns(df: DataFrame, function: Callable[..., dict], schema: str | T.StructType, *extra) -> DataFrame:
    """Apply ``function`` to the columns of each Arrow batch, given as Python lists; it returns lists by column name."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch.to_pydict(), *extra)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def n_words(text: str = "text"):
    """Number of words of a text column; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
