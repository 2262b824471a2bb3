import math
import random

import pytest

from tidemark.columns import REPORT_COLUMNS
from tidemark.operators import evaluate, report, split
from tidemark.operators.quantile import exact_quantile

ROWS = "model_id string, y int, p double, monetary_total double"


def metrics(spark, rows, **more):
    return evaluate.evaluation(spark.createDataFrame(rows, ROWS), **more).first()


def test_evaluation_by_hand(spark):
    rows = [("m", 1, 0.9, 10.0), ("m", 0, 0.2, 20.0), ("m", 0, 0.3, 1000.0)]
    m = metrics(spark, rows)
    assert math.isclose(m["log_loss"], -(math.log(0.9) + math.log(0.8) + math.log(0.7)) / 3)
    assert math.isclose(m["brier_score"], (0.01 + 0.04 + 0.09) / 3)
    assert math.isclose(m["high_value_slice_brier_score"], 0.09)
    # 0.2 has an expected value of exactly 0 and is not contacted
    assert (m["contacted"], m["contacted_churners"], m["eroi"]) == (2, 1, (50.0 - 20.0) / 20.0)


def test_nobody_to_contact_and_certain_scores(spark):
    m = metrics(spark, [("m", 1, 0.2, 1.0), ("m", 0, 0.0, 2.0)])
    assert m["eroi"] == 0.0
    assert math.isfinite(metrics(spark, [("m", 1, 0.0, 1.0), ("m", 0, 1.0, 2.0)])["log_loss"])


def test_without_money_the_overall_score_stands_in(spark):
    df = spark.createDataFrame([("m", 1, 0.9, None), ("m", 0, 0.3, None)], ROWS).drop("monetary_total")
    m = evaluate.evaluation(df).first()
    assert m["high_value_slice_brier_score"] == m["brier_score"]


@pytest.mark.parametrize(
    "challenger, champion, approved",
    [(0.04, None, False), (0.05, None, True), (0.5, 0.48, True), (0.5, 0.49, False), (0.04, -1.0, False)],
)
def test_decision_table(spark, challenger, champion, approved):
    rows = [("new", challenger)] + ([("old", champion)] if champion is not None else [])
    table = spark.createDataFrame(rows, "model_id string, eroi double")
    row = evaluate.decision(table, "new", "old" if champion is not None else None).first()
    assert row["approved"] == approved


def brute_quantile(values, share):
    values = sorted(values)
    position = (len(values) - 1) * share
    low, high = math.floor(position), math.ceil(position)
    return values[low] + (values[high] - values[low]) * (position - low)


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_exact_quantile(spark, share):
    rng = random.Random(1)
    sets = [
        [rng.gauss(0, 10) for _ in range(2000)],
        [5.0] * 700 + [rng.random() * 10 for _ in range(1300)],
        [float(rng.randrange(3)) for _ in range(999)],
        [1.0],
        [-math.e, math.pi],
    ]
    for values in sets:
        df = spark.createDataFrame([(v,) for v in values + [None]], "x double").repartition(7)
        # few values and a coarse sketch make it narrow several times
        for few, accuracy in ((50_000, 10_000), (20, 50), (30, 20)):
            assert math.isclose(exact_quantile(df, "x", share, few, accuracy), brute_quantile(values, share))


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.9) is None


SCORED = "customer_unique_id string, monetary_total double, predicted_probability double"


def test_report(spark):
    rows = [("a", 10.0, 0.5), ("b", 100.0, 0.49), ("c", 5.0, 1.0), ("d", 20.0, 0.9)]
    scored = report.with_revenue_at_risk(spark.createDataFrame(rows, SCORED))
    ranked = report.business_report(scored)
    assert ranked.columns == REPORT_COLUMNS
    assert [r["customer_unique_id"] for r in ranked.collect()] == ["d", "a", "c"]
    assert tuple(report.report_totals(scored).first()) == (4, 3, 28.0)
    bare = report.with_revenue_at_risk(spark.createDataFrame(rows, SCORED).drop("monetary_total"))
    assert {r["revenue_at_risk"] for r in bare.collect()} == {0.0}
    assert "monetary_total" not in report.business_report(bare).columns
    nobody = report.with_revenue_at_risk(spark.createDataFrame([], SCORED))
    assert tuple(report.report_totals(nobody).first()) == (0, 0, 0.0)


def test_class_balance(spark):
    df = spark.createDataFrame([(1,), (0,), (0,)], "target_is_churn int")
    assert tuple(split.class_balance(df).first()) == (3, 1, 2.0, 2.0)
    none = spark.createDataFrame([(0,), (0,)], "target_is_churn int")
    assert tuple(split.class_balance(none).first()) == (2, 0, 1.0, 2.0)


def test_split_keeps_only_named_snapshots(spark):
    days = ["2017-09-01", "2017-11-01", "2018-01-01", "2018-03-01", "2019-01-01"]
    panel = spark.createDataFrame([(d, 1) for d in days], "snapshot_date string, target_is_churn int")
    parts = split.split_by_snapshot(panel, days[:2], days[2], days[3])
    assert tuple(split.split_counts(parts).first()) == (2, 1, 1, 4)
    assert split.one_split(parts, "val").first()["snapshot_date"] == days[2]


def test_label_is_required(spark):
    with pytest.raises(ValueError):
        split.labels_of(spark.createDataFrame([(1,)], "x int"))
    df = spark.createDataFrame([(1, 0, "a")], "x int, target_is_churn int, customer_unique_id string")
    assert split.features_of(df).columns == ["x"]
