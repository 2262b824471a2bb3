from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.orders import raw
from tidemark.columns import REPORT_COLUMNS
from tidemark.operators import report
from tidemark.sources import files, footers, sinks
from tidemark.streaming import daily

DAYS = "order_id string, value int, year string, month string, day string"
FIRST, SECOND = date(2018, 6, 9), date(2018, 6, 10)


def lake(spark, *rows):
    return spark.createDataFrame([(i, v, f"{d:%Y}", f"{d:%m}", f"{d:%d}") for i, v, d in rows], DAYS)


def content(df):
    return sorted(map(tuple, df.collect()))


def test_days_are_replaced_not_repeated(spark, tmp_path):
    root = str(tmp_path / "orders")
    both = lake(spark, ("a", 1, FIRST), ("b", 2, SECOND))
    assert daily.write_days(both, root) == [FIRST, SECOND]
    daily.write_days(both, root)
    assert content(files.scan_partitioned(spark, root)) == content(both)
    daily.write_days(lake(spark, ("c", 3, SECOND)), root)
    assert content(files.scan_partitioned(spark, root).select("order_id", "day")) == [("a", "09"), ("c", "10")]
    daily.write_day(lake(spark), root, FIRST)
    assert content(files.scan_partitioned(spark, root).select("order_id")) == [("c",)]


def test_markers(spark, tmp_path):
    root = str(tmp_path / "orders")
    sinks.write_parts(lake(spark, ("a", 1, FIRST), ("b", 2, SECOND)), root, files.DAY_COLUMNS)
    assert daily.completed_days(spark, root) == []
    daily.mark_days(spark, root, [SECOND])
    assert daily.completed_days(spark, root) == [SECOND]
    assert content(daily.scan_completed(spark, root).select("order_id")) == [("b",)]
    # writing a day again takes its marker away until it is complete
    sinks.write_parts(lake(spark, ("c", 1, SECOND)), root, files.DAY_COLUMNS)
    assert not daily.is_complete(spark, root, SECOND)


def test_a_complete_day_is_not_written_again(spark, tmp_path):
    folder = str(tmp_path)
    tables = {"orders": lake(spark, ("a", 1, FIRST)), "payments": lake(spark, ("a", 5, FIRST))}
    assert daily.write_day_once(tables, folder, FIRST)
    assert daily.is_complete(spark, f"{folder}/payments", FIRST)
    assert not daily.write_day_once({k: v.limit(0) for k, v in tables.items()}, folder, FIRST)
    assert files.scan_partitioned(spark, f"{folder}/orders").count() == 1


def test_partition_columns_stay_text_and_prune(spark, tmp_path):
    root = str(tmp_path / "orders")
    daily.write_days(lake(spark, ("a", 1, FIRST), ("b", 2, SECOND)), root)
    rows = files.scan_partitioned(spark, root)
    assert rows.select("month").first()["month"] == "06"
    until = files.days_until(rows, FIRST.isoformat())
    assert [r["order_id"] for r in until.collect()] == ["a"]
    plan = until._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "concat_ws" in plan.split("PartitionFilters")[1].split("]")[0]


def test_discovery(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    df.write.parquet(str(tmp_path / "raw" / "one.parquet"))
    df.write.option("header", True).csv(str(tmp_path / "raw" / "deep" / "two.csv"))
    (tmp_path / "raw" / "notes.txt").write_text("no table")
    found = files.open_tables(spark, str(tmp_path / "raw"), {"two": "a int, b string"})
    assert {name: content(t) for name, t in found.items()} == {"one": [(1, "x")], "two": [(1, "x")]}
    # of two tables with one name the last in path order is used
    df.write.parquet(str(tmp_path / "raw" / "zzz" / "one.parquet"))
    assert "zzz" in files.discover_tables(spark, str(tmp_path / "raw"))["one"]
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        files.discover_tables(spark, str(tmp_path / "empty"))


TRICKY = [(1, 'said "hi", twice'), (2, "two\nlines"), (3, None), (4, "back\\slash"), (5, "ünïcode")]


def test_text_survives_csv(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, "n int, t string")
    parquet, csv, again = (str(tmp_path / x) for x in ("a.parquet", "b.csv", "c.parquet"))
    df.write.parquet(parquet)
    files.parquet_to_csv(spark, parquet, csv)
    files.csv_to_parquet(spark, csv, again)
    assert sorted(map(tuple, spark.read.parquet(again).collect())) == TRICKY
    with pytest.raises(Exception):
        files.csv_to_parquet(spark, csv, again, replace=False)


def test_one_bad_table_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bad.csv").write_text("n\nx\n")
    (tmp_path / "in" / "good.csv").write_text("n\n1\n2\n")
    from pyspark.sql.types import StructType

    odd = StructType.fromDDL("n int, n int")  # a schema no table can have
    rows = files.convert_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"bad": odd}).collect()
    assert {r["table"]: r["converted"] for r in rows} == {"bad": False, "good": True}
    assert spark.read.parquet(str(tmp_path / "out" / "good.parquet")).count() == 2


def test_stored_size(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(1000).repartition(3).write.parquet(path)
    row = footers.stored_size(spark, path).first()
    on_disk = sum(f.stat().st_size for f in (tmp_path / "t.parquet").glob("*.parquet"))
    assert (row["total_rows"], row["total_bytes"]) == (1000, on_disk)


SCORED = "customer_unique_id string, monetary_total double, predicted_probability double, revenue_at_risk double"


def test_empty_report_has_a_header(spark, tmp_path):
    path = tmp_path / "report"
    sinks.write_report_csv(report.business_report(spark.createDataFrame([], SCORED)), str(path))
    text = "".join(f.read_text() for f in path.glob("*.csv"))
    assert text.strip() == ",".join(REPORT_COLUMNS)


def test_report_file_is_in_order(spark, tmp_path):
    rows = [(f"c{i}", 1.0, 0.9, float(i * 7 % 100)) for i in range(100)]
    path = tmp_path / "report"
    sinks.write_report_csv(report.business_report(spark.createDataFrame(rows, SCORED)), str(path))
    lines = [line for f in sorted(path.glob("part-*.csv")) for line in f.read_text().splitlines()[1:]]
    risks = [float(line.split(",")[-1]) for line in lines]
    assert len(risks) == 100 and risks == sorted(risks, reverse=True)


def test_publishing_needs_both_files(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([("a", 1.0, 0.9, 0.9), ("b", 1.0, 0.8, 3.0)], SCORED)
    sinks.write_report_csv(report.business_report(rows), f"{base}/report")
    args = (spark, f"{base}/report", f"{base}/log", f"{base}/reports", f"{base}/logs", SECOND)
    with pytest.raises(FileNotFoundError):
        daily.publish_reports(*args)
    assert not (tmp_path / "reports").exists()
    sinks.write_log(report.telemetry(rows, "r", "m"), f"{base}/log")
    targets = daily.publish_reports(*args)
    assert targets[0].endswith("reports/year=2018/month=06/day=10")
    assert files.scan_csv(spark, targets[0]).count() == 2
    assert files.scan_partitioned(spark, f"{base}/logs").first()["month"] == "06"


def test_declared_tables_are_split_and_others_keep_their_line_breaks(spark, tmp_path):
    plain = "id,text\n" + "".join(f"{i},{'x' * 90}\n" for i in range(20_000))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "plain.csv").write_text(plain)
    (tmp_path / "in" / "broken.csv").write_text('id,text\n1,"a\nb"\n2,c\n')
    schemas = {"plain": "id int, text string", "broken": "id int, text string"}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        tables = files.open_tables(spark, str(tmp_path / "in"), schemas, single_line=["plain"])
        assert tables["plain"].rdd.getNumPartitions() > 4
        report = files.convert_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), schemas, single_line=["plain"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["converted"] for r in report.collect()] == [True, True]
    assert spark.read.parquet(str(tmp_path / "out" / "plain.parquet")).count() == 20_000
    assert content(spark.read.parquet(str(tmp_path / "out" / "broken.parquet"))) == [(1, "a\nb"), (2, "c")]


def test_published_reports_are_unchanged(spark, tmp_path):
    """Reports of other columns, and rows without a probability, arrive as they were written."""
    base = str(tmp_path)
    log = spark.createDataFrame([("a", 1.0, 0.9, 0.9)], SCORED)
    sinks.write_log(log, f"{base}/log")
    three = spark.createDataFrame([("a", 0.9, 5.0), ('b "x",\ny', None, 3.0)], "id string, predicted_probability double, revenue_at_risk double")
    sinks.write_report_csv(three.coalesce(1), f"{base}/report")
    for day in (FIRST, FIRST):  # publishing again replaces the day
        target, _ = daily.publish_reports(spark, f"{base}/report", f"{base}/log", f"{base}/reports", f"{base}/logs", day)
    sent = {p.name: p.read_bytes() for p in (tmp_path / "report").glob("part-*")}
    assert sent == {p.name: p.read_bytes() for p in Path(target).glob("part-*")}
    assert files.scan_csv(spark, target).columns == three.columns


def test_panel_keeps_its_columns(spark, tmp_path):
    from tests.test_features import SNAPSHOTS, awkward_tables, rows_of
    from tidemark.plans.panel import build_panel

    panel = build_panel(awkward_tables(spark), SNAPSHOTS, stamp=False)
    sinks.write_panel(panel, str(tmp_path / "panel"))
    read = sinks.read_panel(spark, str(tmp_path / "panel"))
    assert read.columns == panel.columns and rows_of(read) == rows_of(panel)
    one = read.filter(F.col("snapshot_date") == "2018-01-01")
    # storing a panel of fewer snapshots leaves nothing of the larger one
    sinks.write_panel(build_panel(awkward_tables(spark), SNAPSHOTS[:1], stamp=False), str(tmp_path / "panel"))
    left = sinks.read_panel(spark, str(tmp_path / "panel")).select("snapshot_date").distinct().collect()
    assert [r[0] for r in left] == [SNAPSHOTS[0].label]
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().executedPlan().toString()


def test_raw_helper_is_typed(spark):
    orders, _, _ = raw(spark, [], [], [])
    assert orders.schema["order_purchase_timestamp"].dataType.simpleString() == "string"
