"""Daily partitions: written so that a repeated run changes nothing, marked when complete, read when marked.

A day is a folder ``year=YYYY/month=MM/day=DD`` with zero-padded numbers. Spark leaves a ``_SUCCESS`` file in a folder
it has completely written; that file is the day's marker. Overwriting a day removes the marker first.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import DAY_COLUMNS, file_system, hadoop_path, path_exists, scan_partitioned
from tidemark.sources.sinks import write_parts

MARKER = "_SUCCESS"


def day_folder(root: str, day: date) -> str:
    return f"{root}/year={day:%Y}/month={day:%m}/day={day:%d}"


def day_columns(moment: Column) -> list[Column]:
    """Partition columns of a timestamp, as text."""
    return [F.date_format(moment, f).alias(n) for n, f in zip(DAY_COLUMNS, ("yyyy", "MM", "dd"))]


def write_day(df: DataFrame, root: str, day: date) -> None:
    """Replace one day, also by nothing. The commit of the write sets the marker."""
    df.drop(*DAY_COLUMNS).hint("rebalance").write.mode("overwrite").parquet(day_folder(root, day))


def write_days(df: DataFrame, root: str) -> list[date]:
    """Replace every day that occurs in ``df``, which carries the partition columns, and mark those days.

    The input is computed once. The days are counted while they are written, so exactly what was written is marked.
    """
    seen = Observation()
    day = F.concat_ws("-", *DAY_COLUMNS)
    # One value per calendar day.
    write_parts(df.observe(seen, F.collect_set(day).alias("days")), root, DAY_COLUMNS)
    days = sorted(date(*map(int, d.split("-"))) for d in seen.get["days"])
    mark_days(df.sparkSession, root, days)
    return days


def mark_days(spark: SparkSession, root: str, days: Iterable[date]) -> None:
    system = file_system(spark, root)
    for day in days:
        system.create(hadoop_path(spark, f"{day_folder(root, day)}/{MARKER}"), True).close()


def is_complete(spark: SparkSession, root: str, day: date) -> bool:
    return path_exists(spark, f"{day_folder(root, day)}/{MARKER}")


def write_day_once(tables: dict[str, DataFrame], folder: str, day: date, first: str = "orders") -> bool:
    """Write one day of several tables unless table ``first`` already has it. Tells whether it wrote.

    ``first`` is written last, so its marker says that the day of every table is there.
    """
    spark = tables[first].sparkSession
    if is_complete(spark, f"{folder}/{first}", day):
        return False
    for name in sorted(tables, key=lambda n: n == first):
        write_day(tables[name], f"{folder}/{name}", day)
    return True


def completed_days(spark: SparkSession, root: str) -> list[date]:
    pattern = hadoop_path(spark, f"{root}/year=*/month=*/day=*/{MARKER}")
    found = file_system(spark, root).globStatus(pattern) or []
    days = []
    for status in found:
        parts = dict(p.split("=") for p in status.getPath().getParent().toString().split("/")[-3:])
        days.append(date(int(parts["year"]), int(parts["month"]), int(parts["day"])))
    return sorted(days)


def scan_completed(spark: SparkSession, root: str) -> DataFrame:
    """The marked days of a daily table. Other folders are pruned, not read."""
    days = [d.isoformat() for d in completed_days(spark, root)]
    return scan_partitioned(spark, root).filter(F.concat_ws("-", *DAY_COLUMNS).isin(days))


def publish_reports(
    spark: SparkSession, report_path: str, log_path: str, report_base: str, log_base: str, run_day: date
) -> tuple[str, str]:
    """Copy a stored report and its log to the folders of the run day. Both must exist before either is copied.

    The report's files are copied as they are, whatever columns they have; a report is as long as the list of flagged
    customers, and passes in blocks. The log has a row per customer and is copied by tasks.
    """
    for path in (report_path, log_path):
        if not path_exists(spark, path):
            raise FileNotFoundError(path)
    targets = day_folder(report_base, run_day), day_folder(log_base, run_day)
    source, target = hadoop_path(spark, report_path), hadoop_path(spark, targets[0])
    system = file_system(spark, targets[0])
    system.delete(target, True)
    system.mkdirs(target.getParent())
    copy = spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    if not copy(file_system(spark, report_path), source, system, target, False, True, spark._jsc.hadoopConfiguration()):
        raise OSError(f"{report_path} could not be copied")
    spark.read.parquet(log_path).write.mode("overwrite").parquet(targets[1])
    return targets
