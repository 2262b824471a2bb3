"""Timestamps without time zone, and the snapshots a panel is taken at."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType

# Year, month and day are all required; a time, if any, needs hours and minutes. Blanks may lead, and stand before the time;
# month and day follow the same sign. Spark's own cast also takes '2017', '2017-09' and bare hours, which are not timestamps.
TIMESTAMP_TEXT = r"^\s*(\d{1,6})([-/\\ ])(\d{1,2})\2(\d{1,2})(?:(?:T\s*|\s+)(\d{1,2}:.*?):?\s*)?$"
MIDNIGHT = r"^24:00(:00(\.0*)?)?$"


class Snapshot(NamedTuple):
    """A cut-off: the text stored with each row, and the instant it stands for."""

    label: str
    at: datetime

    def window_end(self, days: int) -> datetime:
        return self.at + timedelta(days=days)


def snapshot(value: str | date | datetime) -> Snapshot:
    """A snapshot from ISO text, a date or a datetime."""
    if isinstance(value, str):
        return Snapshot(value, datetime.fromisoformat(value))
    if isinstance(value, datetime):
        return Snapshot(value.isoformat(sep=" "), value)
    return Snapshot(value.isoformat(), datetime(value.year, value.month, value.day))


def instant(value: datetime) -> Column:
    """A timestamp literal without time zone; it folds to a constant and reaches the Parquet scan."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_timestamp(text: Column) -> Column:
    """Timestamp of a text column, NULL where the text is not a full date or date and time.

    A zone offset is dropped and the wall clock kept. 24:00 is the start of the next day; 'epoch' is a timestamp too.
    Infinite times and years before 1 cannot be held and are NULL; ``unreadable_times`` counts what was lost.
    """

    def part(n: int) -> Column:
        return F.regexp_extract(text, TIMESTAMP_TEXT, n)

    year = F.when(F.length(part(1)) < 4, F.lpad(part(1), 4, "0")).otherwise(part(1))
    day, time = F.concat_ws("-", year, part(3), part(4)), part(5)
    at = F.when(time == "", day).otherwise(F.concat_ws(" ", day, time)).try_cast("timestamp_ntz")
    next_day = day.try_cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    known = F.when(time.rlike(MIDNIGHT), next_day).otherwise(at)
    epoch = F.when(F.lower(F.trim(text)) == "epoch", F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.when(text.rlike(TIMESTAMP_TEXT), known).otherwise(epoch)


def unreadable_times(df: DataFrame, name: str) -> DataFrame:
    """Number of texts in a column that are there but are no timestamp: (column_name, unreadable)."""
    lost = F.col(name).isNotNull() & as_timestamp(df, name).isNull()
    return df.agg(F.count_if(lost).alias("unreadable")).select(F.lit(name).alias("column_name"), "unreadable")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a timestamp: parsed if it is text, unchanged if it already is one."""
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        return parse_timestamp(F.col(name))
    if isinstance(kind, TimestampNTZType):
        return F.col(name)
    if isinstance(kind, DateType):
        return F.col(name).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(name).cast("timestamp_ntz"))


def days_between(start: Column, end: Column) -> Column:
    """Day boundaries from start to end: 23:59:59 to the next 00:00:00 is one day."""
    return F.datediff(end, start).cast("bigint")


def utc_now() -> Column:
    """Current UTC wall clock, whatever zone the session uses."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))


def in_window(moment: Column, start: datetime, days: int) -> Column:
    """``[start, start + days)``: the lower end belongs to the window, the upper does not."""
    return (moment >= instant(start)) & (moment < instant(start) + F.expr(f"INTERVAL '{days}' DAY"))
