"""Finding, reading and converting tables in files."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Partition columns of the daily layout, and the file kinds a table may come in.
DAY_COLUMNS = ["year", "month", "day"]
TABLE_SUFFIXES = (".parquet", ".csv")


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that ``path`` lives on."""
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """One table from a Parquet file or folder; nothing is read until a result is asked for."""
    return spark.read.parquet(path)


TYPED_PARTITIONS = "spark.sql.sources.partitionColumnTypeInference.enabled"


def scan_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """A partitioned Parquet tree whose partition columns stay text: month '06', not 6. The folders are listed once."""
    before = spark.conf.get(TYPED_PARTITIONS)
    spark.conf.set(TYPED_PARTITIONS, "false")
    try:
        return spark.read.parquet(root)
    finally:
        spark.conf.set(TYPED_PARTITIONS, before)


def scan_table(spark: SparkSession, folder: str, name: str, partitioned: bool = False) -> DataFrame:
    """Table ``name`` of a folder: ``name.parquet``, or the tree below ``name`` if partitioned by day."""
    if partitioned:
        return scan_partitioned(spark, f"{folder}/{name}")
    return scan_parquet(spark, f"{folder}/{name}.parquet")


def days_until(df: DataFrame, last_day: str) -> DataFrame:
    """Partitions up to and including ``last_day`` (``yyyy-MM-dd``). Only partition columns are compared, so later
    folders are never opened."""
    return df.filter(F.concat_ws("-", *DAY_COLUMNS) <= last_day)


def scan_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """A CSV file or folder with a header. Without a schema the types are inferred, which reads the data twice.

    Quoted text may hold line breaks, so each file is read by one task. For large files without such text pass
    ``multi_line=False``; Spark then splits them.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multi_line)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def discover_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name to path for every Parquet or CSV table below ``root``. The last path in order wins a shared name.

    A folder named like a table file is one table and is not searched.
    """
    system = file_system(spark, root)
    found: dict[str, str] = {}
    folders = [hadoop_path(spark, root)]
    while folders:
        for status in sorted(system.listStatus(folders.pop(0)), key=lambda s: s.getPath().toString()):
            path, name = status.getPath(), status.getPath().getName()
            suffix = next((s for s in TABLE_SUFFIXES if name.endswith(s)), None)
            if suffix:
                found[name.removesuffix(suffix)] = path.toString()
            elif status.isDirectory():
                folders.append(path)
    if not found:
        raise FileNotFoundError(f"no Parquet or CSV table below {root}")
    return found


def open_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    return scan_csv(spark, path, schema, multi_line) if path.endswith(".csv") else scan_parquet(spark, path)


def open_tables(
    spark: SparkSession, root: str, schemas: dict | None = None, single_line: Collection[str] = ()
) -> dict[str, DataFrame]:
    """Every table below ``root``; CSV tables are read with their declared schema where there is one.

    CSV tables named in ``single_line`` have no line breaks inside quotes, so Spark may split their files.
    """
    schemas = schemas or {}
    found = discover_tables(spark, root)
    return {name: open_table(spark, path, schemas.get(name), name not in single_line) for name, path in found.items()}


def _mode(replace: bool) -> str:
    return "overwrite" if replace else "errorifexists"


def csv_to_parquet(
    spark: SparkSession, csv_path: str, parquet_path: str, replace: bool = True, schema=None, multi_line: bool = True
) -> None:
    scan_csv(spark, csv_path, schema, multi_line).write.mode(_mode(replace)).parquet(parquet_path)


def parquet_to_csv(spark: SparkSession, parquet_path: str, csv_path: str, replace: bool = True) -> None:
    writer = scan_parquet(spark, parquet_path).write.mode(_mode(replace))
    writer.option("header", True).option("escape", '"').csv(csv_path)


def convert_folder(
    spark: SparkSession, source: str, target: str, schemas: dict | None = None, single_line: Collection[str] = ()
) -> DataFrame:
    """Every CSV table below ``source`` as Parquet below ``target``, with one report row per table.

    Tables named in ``single_line`` are split, as in ``open_tables``. A table that cannot be converted is reported and does not stop the others.
    """
    schemas = schemas or {}
    report = []
    for name, path in discover_tables(spark, source).items():
        if not path.endswith(".csv"):
            continue
        try:
            csv_to_parquet(
                spark, path, f"{target}/{name}.parquet", schema=schemas.get(name), multi_line=name not in single_line
            )
            report.append((name, True, None))
        except Exception as error:  # any failure of one table is its report row
            report.append((name, False, str(error).splitlines()[0]))
    return spark.createDataFrame(report, "table string, converted boolean, error string")
