"""Scans, sources and sinks: written below the session's shared folder and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registered import sql
from registered.features import panel, scored
from registered.registry import query
from registered.sql import with_base
from tidemark.operators import report
from tidemark.columns import LABEL, REPORT_COLUMNS
from tidemark.operators.split import feature_names, split_by_snapshot
from tidemark.functions.times import snapshot
from tidemark.session import scratch_path
from tidemark.sources import files, footers, sinks
from tidemark.sources import sample_data as data
from tidemark.streaming import daily, state, versions

RUN_DAY = date(1998, 7, 1)
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def split_panel(spark, folder):
    return split_by_snapshot(
        panel(spark, folder), data.TRAIN_SNAPSHOTS, data.VALIDATION_SNAPSHOT, data.TEST_SNAPSHOT
    )


def daily_events(spark, folder):
    """Events with the partition columns of the day they happened."""
    events = data.table(spark, folder, "events")
    return events.select("event_id", "user_id", "event_type", "value", *daily.day_columns(F.col("ts")))


@query("s1_parquet_scan", "SELECT * FROM orders")
def parquet_scan(spark, folder):
    return files.scan_table(spark, folder, "orders")


@query(
    "s2_partitioned_scan",
    "SELECT event_id, value, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day "
    "FROM events WHERE ts < TIMESTAMP '2024-01-16'",
)
def partitioned_scan(spark, folder):
    """Days up to a last one, by partition pruning."""
    root = scratch_path(spark, "lake")
    sinks.write_parts(daily_events(spark, folder), f"{root}/events", files.DAY_COLUMNS)
    lake = files.days_until(files.scan_table(spark, root, "events", partitioned=True), "2024-01-15")
    return lake.select("event_id", "value", *files.DAY_COLUMNS)


@query("s3_csv_scan_inferred", "SELECT * FROM customer")
def csv_scan_inferred(spark, folder):
    path = scratch_path(spark, "customer")
    files.parquet_to_csv(spark, f"{folder}/customer.parquet", path)
    inferred = files.scan_csv(spark, path)
    return inferred.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("s4_csv_scan_declared", "SELECT * FROM customer")
def csv_scan_declared(spark, folder):
    path = scratch_path(spark, "customer")
    files.parquet_to_csv(spark, f"{folder}/customer.parquet", path)
    return files.scan_csv(spark, path, CUSTOMER)


@query("s5_pushed_down_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'")
def pushed_down_scan(spark, folder):
    from tidemark.functions.times import instant

    rows = files.scan_parquet(spark, f"{folder}/orders.parquet")
    return rows.filter(F.col("o_orderdate") < instant(data.SNAPSHOTS[0].at)).select("o_orderkey", "o_totalprice")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@query(
    "s6_discovered_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS num_rows FROM {t}" for t in TABLES),
)
def discovered_tables(spark, folder):
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("num_rows"))
        for name, df in files.open_tables(spark, folder).items()
    ]
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.unionByName(more)
    return rows


@query(
    "s7_converted_folder",
    "SELECT 'conversations' AS table_name, TRUE AS converted, COUNT(*) AS num_rows, "
    "CAST(SUM(LENGTH(text)) AS BIGINT) AS characters FROM conversations UNION ALL "
    "SELECT 'documents', TRUE, COUNT(*), CAST(SUM(LENGTH(text)) AS BIGINT) FROM documents",
)
def converted_folder(spark, folder):
    """Text with quotes and line breaks, to CSV and back through the folder converter."""
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "parquet")
    names = ("conversations", "documents")
    schemas = {}
    for name in names:
        files.parquet_to_csv(spark, f"{folder}/{name}.parquet", f"{source}/{name}.csv")
        schemas[name] = data.table(spark, folder, name).schema
    done = files.convert_folder(spark, source, target, schemas)
    parts = [
        files.scan_table(spark, target, name).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("num_rows"),
            F.sum(F.length("text")).alias("characters"),
        )
        for name in names
    ]
    stored = parts[0].unionByName(parts[1])
    return done.select(F.col("table").alias("table_name"), "converted").join(stored, "table_name")


@query("s8_csv_to_parquet", "SELECT * FROM supplier")
def csv_to_parquet(spark, folder):
    csv, parquet = scratch_path(spark, "supplier"), scratch_path(spark, "supplier")
    files.parquet_to_csv(spark, f"{folder}/supplier.parquet", csv)
    files.csv_to_parquet(spark, csv, parquet, schema=data.table(spark, folder, "supplier").schema)
    return files.scan_parquet(spark, parquet)


@query("s9_parquet_to_csv", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def parquet_to_csv(spark, folder):
    csv = scratch_path(spark, "part")
    files.parquet_to_csv(spark, f"{folder}/part.parquet", csv)
    part = files.scan_csv(spark, csv, data.table(spark, folder, "part").schema)
    return part.select("p_partkey", "p_name", "p_brand", "p_retailprice")


@query("s10_stored_panel", with_base("SELECT * FROM panel", sql.PANEL))
def stored_panel(spark, folder):
    path = scratch_path(spark, "panel")
    sinks.write_panel(panel(spark, folder), path)
    return sinks.read_panel(spark, path)


@query("s11_stored_splits", with_base("SELECT * FROM split", sql.PANEL, sql.SPLIT))
def stored_splits(spark, folder):
    path = scratch_path(spark, "splits")
    rows = split_panel(spark, folder)
    sinks.write_splits(rows, path)
    return spark.read.parquet(path).select(*rows.columns)


@query(
    "s11_stored_features_and_labels",
    with_base("SELECT * EXCLUDE (target_180d_ltv) FROM split", sql.PANEL, sql.SPLIT),
)
def stored_features_and_labels(spark, folder):
    path = scratch_path(spark, "inputs")
    rows = split_panel(spark, folder)
    sinks.write_features_and_labels(rows, feature_names(rows), LABEL, path)
    return spark.read.parquet(path)


@query(
    "s12_daily_write_twice",
    "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, "
    "strftime(ts, '%d') AS day FROM events",
)
def daily_write_twice(spark, folder):
    """All days, all days again, then one day again: the rows are the same."""
    root = scratch_path(spark, "lake")
    events = daily_events(spark, folder)
    daily.write_days(events, root)
    daily.write_days(events, root)
    daily.write_day(events.filter(F.concat_ws("-", *files.DAY_COLUMNS) == "2024-01-10"), root, date(2024, 1, 10))
    return files.scan_partitioned(spark, root)


@query(
    "s12_published_versions",
    """WITH e AS (SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS day FROM events),
v AS (
  SELECT 1 AS version, event_id, value, day FROM e
  UNION ALL
  SELECT 2, event_id, CASE WHEN day = '2024-01-10' THEN value * 2 ELSE value END, day FROM e WHERE day <> '2024-01-11')
SELECT *, COUNT(*) OVER (PARTITION BY version, day) AS rows_of_day FROM v""",
)
def published_versions(spark, folder):
    """Events and their daily counts are published together, then one day again with other values and one by nothing;
    both versions are read."""
    root = scratch_path(spark, "lake")
    events = daily_events(spark, folder)
    day = F.concat_ws("-", *files.DAY_COLUMNS)
    again = events.filter(day == "2024-01-10").withColumn("value", F.col("value") * 2)

    def both(rows):
        return {"events": rows, "counts": rows.groupBy(*files.DAY_COLUMNS).agg(F.count(F.lit(1)).alias("rows_of_day"))}

    versions.publish(both(events), root)
    versions.publish(both(again), root, [date(2024, 1, 10), date(2024, 1, 11)])
    parts = []
    for version in (1, 2):
        tables = versions.read_version(spark, root, version)
        rows = tables["events"].join(tables["counts"], files.DAY_COLUMNS)
        parts.append(rows.select(F.lit(version).alias("version"), "event_id", "value", day.alias("day"), "rows_of_day"))
    return parts[0].unionByName(parts[1])


@query("s13_completed_days", "SELECT event_id, value FROM events WHERE ts < TIMESTAMP '2024-01-21'")
def completed_days(spark, folder):
    """All days are written but only the first twenty are marked; only marked days are read."""
    root = scratch_path(spark, "lake")
    sinks.write_parts(daily_events(spark, folder), root, files.DAY_COLUMNS)
    daily.mark_days(spark, root, [date(2024, 1, d) for d in range(1, 21)])
    return daily.scan_completed(spark, root).select("event_id", "value")


@query("s13_incremental_state", with_base(sql.features("1998-05-01")))
def incremental_state(spark, folder):
    """Features at a snapshot from the stored state. Years, and from 1998 on months, of all orders are published in three versions,
    each followed by an update: up to 1996, with one year missing and one with wrong money; these two again; the rest."""
    root = scratch_path(spark, "state")
    lake = f"{root}/lake"
    bought = F.col("order_purchase_timestamp")
    batch = F.when(F.year(bought) < 1998, F.trunc(bought, "year")).otherwise(F.trunc(bought, "month"))
    dated = data.raw_orders(spark, folder).select("*", *daily.day_columns(batch))
    links = dated.select("customer_id", *files.DAY_COLUMNS).distinct()
    everything = {
        "orders": dated,
        "customers": links.join(data.raw_customers(spark, folder), "customer_id"),
        "payments": dated.select("order_id", *files.DAY_COLUMNS).join(data.raw_payments(spark, folder), "order_id"),
    }
    # Stored once: every version below reads only its own days of them, instead of joining all orders and line items again.
    for name, df in everything.items():
        sinks.write_parts(df, f"{root}/dated/{name}", files.DAY_COLUMNS)
        everything[name] = spark.read.schema(df.schema).parquet(f"{root}/dated/{name}")
    year = F.col("year")
    first = {name: df.filter((year < "1997") & (year != "1994")) for name, df in everything.items()}
    money = F.when(year == "1995", 2).otherwise(1) * F.col("payment_value")
    first["payments"] = first["payments"].withColumn("payment_value", money.cast("decimal(18,2)"))
    for tables in (
        first,
        {name: df.filter(year.isin("1994", "1995")) for name, df in everything.items()},
        {name: df.filter(year >= "1997") for name, df in everything.items()},
    ):
        versions.publish(tables, lake)
        state.update(spark, lake, f"{root}/persons", buckets=8)
    return state.features_at(spark, f"{root}/persons", snapshot("1998-05-01"))


REPORT_SQL = with_base(
    "SELECT customer_unique_id, predicted_probability, monetary_total, revenue_at_risk FROM scored "
    "WHERE predicted_probability >= 0.5",
    sql.MATRIX,
    sql.SCORED,
)
REPORT = "customer_unique_id bigint, predicted_probability double, monetary_total double, revenue_at_risk double"


@query("s14_report_csv", REPORT_SQL)
def report_csv(spark, folder):
    path = scratch_path(spark, "report")
    sinks.write_report_csv(report.business_report(scored(spark, folder)), path)
    return files.scan_csv(spark, path, REPORT)


TELEMETRY_SQL = with_base(
    "SELECT *, 'run-1' AS inference_run_id, 'model-1' AS champion_model_id FROM scored", sql.MATRIX, sql.SCORED
)


@query("s15_telemetry_log", TELEMETRY_SQL)
def telemetry_log(spark, folder):
    path = scratch_path(spark, "log")
    sinks.write_log(report.telemetry(scored(spark, folder), "run-1", "model-1"), path)
    return spark.read.parquet(path).drop("timestamp_utc")


@query(
    "s16_published_reports",
    with_base(
        "SELECT 'log' AS kind, customer_unique_id, revenue_at_risk, '1998' AS year, '07' AS month, '01' AS day "
        "FROM scored UNION ALL SELECT 'report', customer_unique_id, revenue_at_risk, '1998', '07', '01' FROM scored "
        "WHERE predicted_probability >= 0.5",
        sql.MATRIX,
        sql.SCORED,
    ),
)
def published_reports(spark, folder):
    base = scratch_path(spark, "published")
    rows = scored(spark, folder)
    sinks.write_report_csv(report.business_report(rows), f"{base}/run/report")
    sinks.write_log(report.telemetry(rows, "run-1", "model-1"), f"{base}/run/log")
    daily.publish_reports(spark, f"{base}/run/report", f"{base}/run/log", f"{base}/reports", f"{base}/logs", RUN_DAY)
    columns = ["kind", "customer_unique_id", "revenue_at_risk", *files.DAY_COLUMNS]
    log = files.scan_partitioned(spark, f"{base}/logs").withColumn("kind", F.lit("log")).select(*columns)
    csv = files.scan_csv(spark, f"{base}/reports", f"{REPORT}, year string, month string, day string")
    return log.unionByName(csv.withColumn("kind", F.lit("report")).select(*columns))


@query("s17_stored_rows", "SELECT COUNT(*) AS total_rows, TRUE AS has_bytes FROM lineitem")
def stored_rows(spark, folder):
    size = footers.stored_size(spark, f"{folder}/lineitem.parquet")
    return size.select("total_rows", (F.col("total_bytes") > 0).alias("has_bytes"))


@query(
    "s17_column_ranges",
    """WITH r AS (
  SELECT COUNT(*) AS n_rows, COUNT(l_quantity) AS q, MIN(l_quantity) AS q0, MAX(l_quantity) AS q1, COUNT(l_orderkey) AS k,
         MIN(l_orderkey) AS k0, MAX(l_orderkey) AS k1 FROM lineitem)
SELECT 'l_orderkey' AS column_name, n_rows, k AS n_values, CAST(k0 AS DOUBLE) AS smallest, CAST(k1 AS DOUBLE) AS largest FROM r
UNION ALL SELECT 'l_quantity', n_rows, q, q0, q1 FROM r""",
)
def column_ranges(spark, folder):
    found = footers.column_ranges(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_quantity"])
    number = [F.col(c).cast("double").alias(c) for c in ("smallest", "largest")]
    return found.select("column_name", "n_rows", "n_values", *number)


# --- reports on a fixed score


@query(
    "p6_flagged_customers",
    with_base(
        "SELECT customer_unique_id, predicted_probability FROM scored WHERE predicted_probability >= 0.5",
        sql.MATRIX,
        sql.SCORED,
    ),
)
def flagged_customers(spark, folder):
    return report.flagged(scored(spark, folder)).select("customer_unique_id", "predicted_probability")


@query("p8_report_columns", REPORT_SQL)
def report_columns(spark, folder):
    return report.flagged(scored(spark, folder)).select(*REPORT_COLUMNS)


@query("p17_run_columns", TELEMETRY_SQL)
def run_columns(spark, folder):
    return report.telemetry(scored(spark, folder), "run-1", "model-1").drop("timestamp_utc")


@query(
    "a19_report_totals",
    with_base(
        "SELECT COUNT(*) AS total_customers_scored, "
        "COUNT(*) FILTER (WHERE predicted_probability >= 0.5) AS total_churners_flagged, "
        "ROUND(COALESCE(SUM(CAST(revenue_at_risk AS DECIMAL(38,6))) FILTER (WHERE predicted_probability >= 0.5), 0), 2)"
        "::DOUBLE AS total_revenue_at_risk FROM scored",
        sql.MATRIX,
        sql.SCORED,
    ),
)
def report_totals(spark, folder):
    return report.report_totals(scored(spark, folder))


@query("o1_ranked_report", REPORT_SQL + " ORDER BY revenue_at_risk DESC, customer_unique_id")
def ranked_report(spark, folder):
    return report.business_report(scored(spark, folder))


@query("m10_revenue_at_risk_report", REPORT_SQL + " ORDER BY revenue_at_risk DESC, customer_unique_id")
def revenue_at_risk_report(spark, folder):
    """From matrix to stored report, as the scoring job does it."""
    log, path = scratch_path(spark, "log"), scratch_path(spark, "report")
    sinks.write_log(report.telemetry(scored(spark, folder), "run-1", "model-1"), log)
    sinks.write_report_csv(report.business_report(spark.read.parquet(log)), path)
    return files.scan_csv(spark, path, REPORT)
