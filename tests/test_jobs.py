import datetime as dt

import pytest
from pyspark.sql import functions as F

from pyspark.ml import PipelineModel

from registered.models import SMALL_SPACE
from tests.orders import order, raw
from tidemark.functions.times import snapshot
from tidemark.operators import evaluate, model
from tidemark.columns import FEATURE_COLUMNS, PANEL_COLUMNS
from tidemark.operators.features import point_in_time_features
from tidemark.plans.jobs import GateClosed, daily_tables, panel_job, scoring_job, training_job
from tidemark.plans.panel import build_panel
from tidemark.sources.tables import typed_tables
from tidemark.streaming import daily

SNAPSHOTS = [snapshot(s) for s in ("2017-09-01", "2017-11-01", "2018-01-01", "2018-03-01")]
RULES = {
    "tables": {
        "orders": {"num_columns": 6, "columns": {"order_id": {"dtype": "VARCHAR", "unique": True}}},
        "customers": {"num_columns": 3, "columns": {"customer_id": {"dtype": "VARCHAR", "unique": True}}},
        "payments": {"num_columns": 2, "columns": {"payment_value": {"dtype": "DOUBLE"}}},
    }
}


def many_orders():
    start = dt.datetime(2017, 3, 1)
    orders, customers, payments = [], [], []
    for i in range(600):
        bought = start + dt.timedelta(hours=21 * i)
        # people with an even number stop buying after a while
        person = i * 7 % 40
        if person % 2 == 0 and bought > dt.datetime(2017, 8, 20):
            continue
        delivered = None if i % 11 == 0 else (bought + dt.timedelta(days=5 + i % 9)).strftime("%Y-%m-%d")
        due = (bought + dt.timedelta(days=9)).strftime("%Y-%m-%d")
        orders.append(order(f"o{i}", f"c{i}", bought.strftime("%Y-%m-%d %H:%M:%S"), due, delivered,
                            "canceled" if i % 13 == 0 else "delivered"))
        customers.append((f"c{i}", f"p{person}", ["SP", "RJ", "MG"][person % 3]))
        payments += [(f"o{i}", 10.0 + i % 50), (f"o{i}", 5.0)]
    return orders, customers, payments


@pytest.fixture(scope="module")
def raw_tables(spark):
    return dict(zip(("orders", "customers", "payments"), raw(spark, *many_orders())))


@pytest.fixture(scope="module")
def panel_result(spark, raw_tables, tmp_path_factory):
    return panel_job(spark, raw_tables, RULES, SNAPSHOTS, str(tmp_path_factory.mktemp("panel")))


def test_panel_job(panel_result, raw_tables):
    panel = panel_result["panel"]
    assert panel.columns == PANEL_COLUMNS
    plain = build_panel(typed_tables(**raw_tables), SNAPSHOTS, plan="union", stamp=False)
    assert panel.drop("ingested_at_utc").exceptAll(plain).isEmpty()
    assert plain.exceptAll(panel.drop("ingested_at_utc")).isEmpty()
    assert panel_result["profile"].first()["total_rows"] == panel_result["size"].first()["total_rows"] == panel.count()
    assert panel_result["checks"].filter("NOT passed").isEmpty()


def test_typed_tables_can_be_kept(spark, raw_tables, panel_result, tmp_path):
    result = panel_job(spark, raw_tables, RULES, SNAPSHOTS, str(tmp_path), store_typed=True)
    assert result["panel"].drop("ingested_at_utc").exceptAll(panel_result["panel"].drop("ingested_at_utc")).isEmpty()
    assert spark.read.parquet(str(tmp_path / "typed" / "orders.parquet")).schema["purchase_ts"].dataType.typeName() == (
        "timestamp_ntz"
    )


def test_panel_job_stops_at_bad_tables(spark, raw_tables, tmp_path):
    bad = raw_tables | {"orders": raw_tables["orders"].unionByName(raw_tables["orders"].limit(1))}
    with pytest.raises(GateClosed) as stopped:
        panel_job(spark, bad, RULES, SNAPSHOTS, str(tmp_path))
    assert [r["rule"] for r in stopped.value.checks.filter("NOT passed").collect()] == ["unique"]
    assert not (tmp_path / "panel").exists()


@pytest.fixture(scope="module")
def trained(panel_result, tmp_path_factory):
    draws = model.sampled_parameters(2, SMALL_SPACE)
    labels = [s.label for s in SNAPSHOTS]
    folder = str(tmp_path_factory.mktemp("training"))
    return training_job(panel_result["panel"], labels[:2], labels[2], labels[3], folder, draws=draws, folds=2)


def test_training_job(trained, panel_result, tmp_path):
    assert trained.decision.first()["reason"] in ("no champion", "below minimum return")
    assert trained.blueprint.count() == 9 and trained.importance.count() == 9 and len(trained.trials) == 2
    labels = [s.label for s in SNAPSHOTS]
    again = training_job(panel_result["panel"], labels[:2], labels[2], labels[3], str(tmp_path),
                         champion=trained.model, draws=model.sampled_parameters(2, SMALL_SPACE), folds=2, threads=2)
    assert {r["model_id"] for r in again.metrics.collect()} == {"challenger", "champion"}
    assert again.decision.first()["champion_eroi"] is not None
    assert again.trials == trained.trials  # fits that run together give the same models


def test_only_an_approved_model_is_stored(spark, panel_result, tmp_path, monkeypatch):
    labels = [s.label for s in SNAPSHOTS]
    draws = model.sampled_parameters(1, SMALL_SPACE)
    decision = evaluate.decision
    for approved in (False, True, False):
        stored = PipelineModel.load(str(tmp_path / "model")).uid if (tmp_path / "model").exists() else None

        def answer(metrics, *rivals, yes=approved):
            return decision(metrics, *rivals).withColumn("approved", F.lit(yes))

        monkeypatch.setattr(evaluate, "decision", answer)
        training_job(panel_result["panel"], labels[:2], labels[2], labels[3], str(tmp_path), draws=draws, folds=2)
        after = PipelineModel.load(str(tmp_path / "model")).uid if (tmp_path / "model").exists() else None
        assert (after != stored) == approved
        assert (tmp_path / "contract" / "features").exists() == (after is not None)
        for name, rows in (("metrics", 1), ("decision", 1), ("importance", 9), ("trials", 1)):
            assert spark.read.parquet(str(tmp_path / "reports" / name)).count() == rows


def test_scoring_reads_the_stored_contract(spark, raw_tables, trained, tmp_path):
    trained.blueprint.withColumn("max", F.when(F.col("name") == "recency_days", 1.0).otherwise(F.col("max"))).write.json(
        str(tmp_path / "contract" / "features")
    )
    trained.categories.where("value <> 'SP'").write.parquet(str(tmp_path / "contract" / "categories"))
    result = scoring_job(
        typed_tables(**raw_tables), trained.model, str(tmp_path / "contract"), str(tmp_path / "run"), SNAPSHOTS[2]
    )
    warned = {r["feature"] for r in result["checks"].filter("severity = 'warn' AND NOT passed").collect()}
    assert {"recency_days", "customer_state"} <= warned


def write_lake(spark, raw_tables, folder):
    orders = raw_tables["orders"]
    moment = F.col("order_purchase_timestamp").cast("timestamp_ntz")
    days = orders.select("order_id", "customer_id", *daily.day_columns(moment))
    daily.write_days(orders.withColumns({c: days_column for c, days_column in zip(
        ("year", "month", "day"), daily.day_columns(moment))}), f"{folder}/orders")
    daily.write_days(raw_tables["customers"].join(days.drop("order_id"), "customer_id"), f"{folder}/customers")
    daily.write_days(raw_tables["payments"].join(days.drop("customer_id"), "order_id"), f"{folder}/payments")


def test_scoring_job(spark, raw_tables, trained, tmp_path):
    write_lake(spark, raw_tables, str(tmp_path / "lake"))
    tables = daily_tables(spark, str(tmp_path / "lake"), SNAPSHOTS[2])
    flat = point_in_time_features(typed_tables(**raw_tables), SNAPSHOTS[2])
    assert flat.exceptAll(point_in_time_features(tables, SNAPSHOTS[2])).isEmpty()

    expected = [(r["name"], r["physical_type"]) for r in trained.blueprint.orderBy("index").collect()]
    result = scoring_job(tables, trained.model, expected, str(tmp_path / "run"), SNAPSHOTS[2], "r1", "m1")
    assert result["scored"].columns[: len(FEATURE_COLUMNS)] == FEATURE_COLUMNS
    assert result["scored"].select("inference_run_id", "champion_model_id").distinct().collect() == [("r1", "m1")]
    assert result["totals"].first()["total_customers_scored"] == flat.count()
    daily.publish_reports(spark, str(tmp_path / "run" / "report"), str(tmp_path / "run" / "log"),
                          str(tmp_path / "out" / "reports"), str(tmp_path / "out" / "logs"), dt.date(2018, 1, 1))


def test_scoring_job_stops_at_a_broken_contract(spark, raw_tables, trained, tmp_path):
    tables = typed_tables(**raw_tables)
    with pytest.raises(GateClosed):
        scoring_job(tables, trained.model, [("unknown_feature", "bigint")], str(tmp_path), SNAPSHOTS[2])
    with pytest.raises(GateClosed) as stopped:
        scoring_job(tables, trained.model, [("recency_days", "bigint")], str(tmp_path), snapshot("2000-01-01"))
    assert [r["rule"] for r in stopped.value.checks.filter("severity = 'error'").collect()] == ["population"]
    assert not (tmp_path / "log").exists()
