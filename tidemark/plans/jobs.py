"""The three jobs: build a panel, train a model, score customers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tidemark.columns import LABEL, MONEY, PROBABILITY, SPLITS
from tidemark.functions.times import Snapshot, snapshot
from tidemark.operators import contract, evaluate, model, quality, report
from tidemark.operators.features import point_in_time_features
from tidemark.operators.split import feature_names, features_of, one_split, split_by_snapshot
from tidemark.plans.panel import build_panel, panel_profile
from tidemark.session import apply_settings, size_shuffles
from tidemark.sources import sinks
from tidemark.sources.files import days_until, scan_table
from tidemark.sources.footers import stored_size
from tidemark.sources.tables import OrderTables, typed_customers, typed_orders, typed_payments, typed_tables


class GateClosed(Exception):
    """A check failed and the job stopped before anything depended on it."""

    def __init__(self, checks: DataFrame):
        super().__init__("checks failed")
        self.checks = checks


def panel_job(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    rule_file: dict,
    snapshots: Sequence[Snapshot],
    folder: str,
    days: int = 180,
    store_typed: bool = False,
    shuffled_bytes: int | None = None,
) -> dict[str, DataFrame]:
    """Check raw tables, build and store the panel. Gives the stored panel and its reports.

    Unique ids the checks have proven let the panel use a cheaper plan. ``store_typed`` also keeps the parsed tables; the
    panel reads each table once, so that pays only if other jobs read them too. ``shuffled_bytes``, about the size of the
    largest table, sizes the shuffles.
    """
    apply_settings(spark)
    if shuffled_bytes is not None:
        size_shuffles(spark, shuffled_bytes)
    checks = quality.check_tables(spark, raw, rule_file)
    sinks.write_checks(checks, f"{folder}/checks")
    checks = spark.read.schema(quality.CHECK_SCHEMA).json(f"{folder}/checks")
    if not quality.gate_is_open(checks):
        raise GateClosed(checks)
    proven = quality.proven_unique(checks)
    tables = typed_tables(raw["orders"], raw["customers"], raw["payments"]).with_proofs(
        unique_orders=("orders", "order_id") in proven, unique_customers=("customers", "customer_id") in proven
    )
    if store_typed:
        tables = sinks.write_typed(spark, tables, f"{folder}/typed")
    sinks.write_panel(build_panel(tables, snapshots, days), f"{folder}/panel")
    panel = sinks.read_panel(spark, f"{folder}/panel")
    return {"panel": panel, "checks": checks, "profile": panel_profile(panel), "size": stored_size(spark, f"{folder}/panel")}


@dataclass
class Trained:
    model: PipelineModel
    metrics: DataFrame
    decision: DataFrame
    blueprint: DataFrame
    categories: DataFrame
    importance: DataFrame
    trials: list[tuple]


def training_job(
    panel: DataFrame,
    train: Sequence[str],
    val: str,
    test: str,
    folder: str,
    champion: PipelineModel | None = None,
    draws: list[dict] | None = None,
    folds: int = model.FOLDS,
    threads: int = 1,
) -> Trained:
    """Split, search, train, calibrate, evaluate and compare with the current model.

    The new model is stored as ``challenger``; only if it is approved it also replaces ``model``, which is the one to score
    with, together with the contract of its features. Metrics, decision, importance and trials are stored in ``reports``.
    ``threads`` fits run at a time; a cluster that one fit does not fill gains from more.
    """
    spark = apply_settings(panel.sparkSession)
    split = split_by_snapshot(panel, train, val, test)
    sinks.write_splits(split, f"{folder}/splits")
    stored = spark.read.parquet(f"{folder}/splits").select(*split.columns)
    train_rows, val_rows, test_rows = (one_split(stored, s) for s in SPLITS)
    names = feature_names(train_rows)

    draws = model.sampled_parameters(model.TRIALS) if draws is None else draws
    best, trials = model.search(train_rows, val_rows, names, draws, threads)
    fitted = model.train_model(train_rows, names, best, folds, threads)
    fitted.write().overwrite().save(f"{folder}/challenger")

    base = model.base_model(train_rows, names, best)
    importance = model.permutation_importance(base, val_rows, model.positive("probability__"), names)

    rivals = {"challenger": fitted} | ({"champion": champion} if champion is not None else {})
    threshold = evaluate.high_value_threshold(test_rows)
    predictions = None
    for model_id, rival in rivals.items():
        part = model.score(rival, test_rows).selectExpr(
            f"'{model_id}' AS model_id", f"{LABEL} AS y", f"{PROBABILITY} AS p", MONEY
        )
        predictions = part if predictions is None else predictions.unionByName(part)
    metrics = evaluate.evaluation(predictions, threshold)
    verdict = evaluate.decision(metrics, "challenger", "champion" if champion is not None else None)

    train_features = features_of(train_rows)
    blueprint, categories = contract.feature_blueprint(train_features), contract.category_values(train_features)
    kept_trials = spark.createDataFrame(
        [(i, draw == best, {k: float(v) for k, v in draw.items()}, loss) for i, (draw, loss) in enumerate(trials)],
        "trial int, is_best boolean, parameters map<string, double>, val_log_loss double",
    )
    reports = {"metrics": metrics, "decision": verdict, "importance": importance, "trials": kept_trials}
    for name, rows in reports.items():
        rows.write.mode("overwrite").parquet(f"{folder}/reports/{name}")
    metrics, verdict = (spark.read.parquet(f"{folder}/reports/{name}") for name in ("metrics", "decision"))
    if verdict.first()["approved"]:
        fitted.write().overwrite().save(f"{folder}/model")
        blueprint.write.mode("overwrite").json(f"{folder}/contract/features")
        categories.write.mode("overwrite").parquet(f"{folder}/contract/categories")
    return Trained(fitted, metrics, verdict, blueprint, categories, importance, trials)


def daily_tables(spark: SparkSession, folder: str, at: Snapshot) -> OrderTables:
    """Tables of the daily layout. A day's folder holds the orders bought that day, so folders after the snapshot's day
    hold no orders before the snapshot and are not opened."""
    orders = days_until(scan_table(spark, folder, "orders", partitioned=True), f"{at.at:%Y-%m-%d}")
    return OrderTables(
        typed_orders(orders),
        typed_customers(scan_table(spark, folder, "customers", partitioned=True)),
        typed_payments(scan_table(spark, folder, "payments", partitioned=True)),
    )


def scoring_job(
    tables: OrderTables,
    fitted: PipelineModel,
    expected: list[tuple[str, str]] | str,
    folder: str,
    at: Snapshot | None = None,
    run_id: str = "run",
    model_id: str = "champion",
    threshold: float = report.FLAG_THRESHOLD,
) -> dict[str, DataFrame]:
    """Build the feature matrix, check it against the model's contract, score it, store report and log.

    ``expected`` is the folder of a contract that training stored, or the names and types of the features. With a stored
    contract the checks also warn of values that training did not see; extra features are warned of in both cases.
    Without a snapshot customers are scored as of today, 00:00 UTC.
    """
    spark = apply_settings(tables.orders.sparkSession)
    at = snapshot(datetime.now(timezone.utc).date()) if at is None else at
    sinks.write_matrix(point_in_time_features(tables, at), f"{folder}/matrix")
    matrix = spark.read.parquet(f"{folder}/matrix")
    blueprint = None
    if isinstance(expected, str):
        blueprint, categories = contract.read_contract(spark, expected)
        expected = contract.blueprint_features(blueprint)
    checks = contract.check_contract(expected, matrix).unionByName(contract.extra_feature_warnings(expected, matrix))
    if blueprint is not None:
        checks = checks.unionByName(contract.domain_warnings(blueprint, categories, matrix))
    sinks.write_checks(checks, f"{folder}/checks")
    if not contract.contract_result(checks).first()["is_valid"]:
        raise GateClosed(checks)
    sinks.write_log(report.telemetry(model.score(fitted, matrix), run_id, model_id), f"{folder}/log")
    scored = spark.read.parquet(f"{folder}/log")
    ranked = report.business_report(scored, threshold)
    sinks.write_report_csv(ranked, f"{folder}/report")
    return {"scored": scored, "report": ranked, "totals": report.report_totals(scored, threshold), "checks": checks}
