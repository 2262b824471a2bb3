"""Physical plans: what is read, what is joined how, and that nothing is multiplied out."""

import re
from datetime import date, timedelta

from tidemark.functions.times import snapshot
from tidemark.operators.features import point_in_time_features
from tidemark.plans.panel import build_panel
from tidemark.sources import sample_data, sinks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return len(re.findall(r"FileScan parquet", plan.split("Initial Plan")[0]))


def stored(spark, folder, path, **proofs):
    tables = sample_data.order_tables(spark, folder)
    return sinks.write_typed(spark, tables.with_proofs(**proofs) if proofs else tables, str(path))


def test_snapshot_filter_reaches_the_scan(spark, folder, tmp_path):
    plan = plan_of(point_in_time_features(stored(spark, folder, tmp_path), sample_data.SNAPSHOTS[0]))
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(purchase_ts,1998-01-01T00:00\)", plan)


def test_cells_plan_reads_each_table_once(spark, folder, tmp_path):
    tables = stored(spark, folder, tmp_path)
    assert scans(plan_of(build_panel(tables, sample_data.SNAPSHOTS, plan="cells"))) == 3
    assert scans(plan_of(build_panel(tables, sample_data.SNAPSHOTS, plan="cells", strict_as_of=True))) == 3
    assert scans(plan_of(build_panel(tables, sample_data.SNAPSHOTS, plan="running"))) == 3
    assert scans(plan_of(build_panel(tables, sample_data.SNAPSHOTS, plan="fan_out"))) == 3
    assert scans(plan_of(build_panel(tables, sample_data.SNAPSHOTS, plan="union"))) == 24


def test_no_plan_multiplies_rows_out(spark, folder, tmp_path):
    tables = stored(spark, folder, tmp_path)
    for name in ("cells", "running", "fan_out", "union"):
        plan = plan_of(build_panel(tables, sample_data.SNAPSHOTS, plan=name))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_large_tables_merge_orders_where_the_join_left_them(spark, folder, tmp_path):
    """Without broadcast: two exchanges for each join, one each for counting customer copies and summing payments, and
    two for the summary. Neither merging repeated orders nor finding the first needs another."""
    tables = stored(spark, folder, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(build_panel(tables, sample_data.SNAPSHOTS)).split("Initial Plan")[-1]
        proven = plan_of(build_panel(tables.with_proofs(True, True), sample_data.SNAPSHOTS)).split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 8
    assert len(re.findall(r"Exchange hashpartitioning", proven)) == 6
    assert "SortAggregate" not in plan.split("Generate")[1].split("customer_id")[0]


def test_rules_and_panel_stay_in_the_jvm(spark, folder):
    from tidemark.operators.quality import check_tables

    tables = sample_data.order_tables(spark, folder)
    for df in (build_panel(tables, sample_data.SNAPSHOTS), check_tables(
        spark, {"t": tables.customers}, {"tables": {"t": {"columns": {"customer_id": {"unique": True}}}}}
    )):
        assert "Python" not in plan_of(df)


def test_running_plan_moves_cells_once_and_sorts_once(spark, folder, tmp_path):
    """No exchange stands above the one that brings a person's cells together, however many snapshots there are."""
    tables = stored(spark, folder, tmp_path)
    daily = [snapshot(date(1998, 1, 1) + timedelta(days=i)) for i in range(40)]
    for strict in (False, True):
        plan = plan_of(build_panel(tables, daily, plan="running", strict_as_of=strict, stamp=False)).split("Initial Plan")[-1]
        above, below = plan.split("Exchange hashpartitioning(customer_unique_id", 1)
        assert above.count("Generate") == 2 and above.count("Sort [") == 1 and "Exchange" not in above
        cells = plan_of(build_panel(tables, daily, plan="cells", strict_as_of=strict, stamp=False)).split("Initial Plan")[-1]
        assert plan.count("Exchange hashpartitioning") == cells.count("Exchange hashpartitioning")
