"""Sizes and ranges from footers."""

import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.sources import footers


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def write(path, rows, **how):
    kinds = pa.schema([("a.b", pa.int64()), ("day", pa.date32()), ("money", pa.decimal128(18, 2)), ("x", pa.float64()), ("t", pa.string())])
    path.parent.mkdir(exist_ok=True)
    pq.write_table(pa.Table.from_pylist(rows, kinds), path, **how)


ROWS = [
    {"a.b": i if i % 3 else None, "day": dt.date(2018, 1, 1 + i), "money": Decimal(i) - 4, "x": float(i) if i < 8 else float("nan"), "t": f"t{i}"}
    for i in range(10)
]
RANGES = [
    ("a.b", 10, 6, "1", "8"),
    ("day", 10, 10, "2018-01-01", "2018-01-10"),
    ("money", 10, 10, "-4.00", "5.00"),
    ("x", 10, 10, "0.0", "nan"),
    ("t", 10, 10, "t0", "t9"),
]


def test_ranges_of_several_files(spark, tmp_path):
    """Files with rows, without rows and with nulls only."""
    folder = tmp_path / "rows.parquet"
    write(folder / "p1.parquet", ROWS[:4], row_group_size=2)
    write(folder / "p2.parquet", ROWS[4:])
    write(folder / "p3.parquet", [])
    assert sorted(map(tuple, footers.column_ranges(spark, str(folder)).collect())) == sorted(RANGES)
    size = footers.stored_size(spark, str(folder)).first()
    assert tuple(size) == (10, sum(p.stat().st_size for p in folder.iterdir()))
    write(folder / "p4.parquet", [dict.fromkeys(ROWS[0])])
    one = footers.column_ranges(spark, str(folder), ["a.b"]).first()
    assert tuple(one) == ("a.b", 11, 6, "1", "8")


def test_footers_answer(spark, tmp_path):
    write(tmp_path / "t" / "p.parquet", ROWS)
    before = [spark.conf.get(k) for k in (footers.V1_SOURCES, footers.PUSHDOWN)]
    with footers.footer_aggregates(spark):
        found = footers.summary_row(spark.read.parquet(str(tmp_path / "t")), ["a.b", "day"])
        plan = plan_of(found)
        assert tuple(found.first()) == (10, 6, 1, 8, 10, dt.date(2018, 1, 1), dt.date(2018, 1, 10))
    assert "PushedAggregation: [COUNT(*), COUNT(`a.b`), MIN(`a.b`), MAX(`a.b`)" in plan
    assert [spark.conf.get(k) for k in (footers.V1_SOURCES, footers.PUSHDOWN)] == before
    listed = footers.stored_size(spark, str(tmp_path / "t"))
    assert "ReadSchema: struct<length:bigint>" in listed._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_files_without_statistics_are_read(spark, tmp_path):
    write(tmp_path / "t" / "p1.parquet", ROWS[:5], write_statistics=False)
    write(tmp_path / "t" / "p2.parquet", ROWS[5:])
    found = footers.column_ranges(spark, str(tmp_path / "t"), ["money", "a.b"]).collect()
    assert [tuple(r) for r in found] == [RANGES[2], RANGES[0]]
    assert footers.stored_size(spark, str(tmp_path / "t")).first()[0] == 10


def test_empty_table(spark, tmp_path):
    write(tmp_path / "t" / "p.parquet", [])
    assert [tuple(r) for r in footers.column_ranges(spark, str(tmp_path / "t"), ["day", "t"]).collect()] == [
        ("day", 0, 0, None, None), ("t", 0, 0, None, None)
    ]
    rows, size = footers.stored_size(spark, str(tmp_path / "t")).first()
    assert rows == 0 and size > 0


def test_missing_table_is_an_error(spark, tmp_path):
    import pytest

    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        footers.stored_size(spark, str(tmp_path / "no")).select(F.col("total_rows")).first()
