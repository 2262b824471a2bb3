import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from registered.models import SMALL, SMALL_SPACE
from tidemark.operators import contract, model, split
from tidemark.columns import LABEL, PROBABILITY, SPLITS
from tidemark.plans.panel import build_panel
from tidemark.sources import sample_data


@pytest.fixture(scope="module")
def parts(spark, folder, tmp_path_factory):
    panel = build_panel(sample_data.order_tables(spark, folder), sample_data.SNAPSHOTS, stamp=False)
    rows = split.split_by_snapshot(panel, sample_data.TRAIN_SNAPSHOTS, sample_data.VALIDATION_SNAPSHOT,
                                   sample_data.TEST_SNAPSHOT)
    path = str(tmp_path_factory.mktemp("split") / "rows")
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    return {name: split.one_split(stored, name) for name in SPLITS}


@pytest.fixture(scope="module")
def fitted(parts):
    return model.train_model(parts["train"], split.feature_names(parts["train"]), SMALL, folds=3)


def scores(fitted, rows):
    return {r[0]: r[1] for r in model.score(fitted, rows).select("customer_unique_id", PROBABILITY).collect()}


def test_codes_follow_the_alphabet_and_unknown_is_last(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "s string")
    codes = model.category_codes(train, "s")
    other = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "s string")
    coded = {r["s"]: r["s" + model.CODE] for r in model.with_codes(other, codes, "s").collect()}
    assert coded == {"a": 0, "b": 1, "z": 2, None: 2}


def test_codes_of_many_values(spark):
    many = spark.range(30_000).select(F.format_string("v%05d", F.col("id")).alias("s"))
    codes = model.category_codes(many.union(many), "s")
    assert codes.where(F.col("code") != F.substring("value", 2, 5).cast("int")).isEmpty() and codes.count() == 30_000


def test_trains_on_many_categories(spark):
    """A text with 50,000 values, one of which decides the label, beside a useful one with few."""
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("customer_unique_id"),
        F.format_string("v%d", F.col("id") % 50_000).alias("many"),
        F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y").alias("few"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias(LABEL),
    )
    base = model.base_model(rows, ["many", "few"], SMALL)
    gains = {r[0]: r[1] for r in model.tree_importance(base, ["many", "few"]).collect()}
    assert gains["few"] > 0.5
    schema = f"customer_unique_id string, many string, few string, {LABEL} int"
    unseen = spark.createDataFrame([("p", "new value", "new value", 0), ("q", None, None, 0)], schema)
    assert base.transform(unseen).count() == 2


def test_scores_are_probabilities_and_repeat(parts, fitted, tmp_path):
    first = scores(fitted, parts["test"])
    assert len(first) == parts["test"].count()
    assert all(0.0 <= p <= 1.0 for p in first.values())
    again = model.train_model(parts["train"], split.feature_names(parts["train"]), SMALL, folds=3)
    assert scores(again, parts["test"]) == first
    fitted.write().overwrite().save(str(tmp_path / "model"))
    assert scores(PipelineModel.load(str(tmp_path / "model")), parts["test"]) == first


def test_scoring_an_empty_or_incomplete_matrix(parts, fitted):
    empty = model.score(fitted, parts["test"].limit(0))
    assert empty.count() == 0 and empty.columns[-2:] == [PROBABILITY, "revenue_at_risk"]
    holes = parts["test"].withColumn("max_delivery_delay_days", F.lit(None).cast("bigint"))
    assert all(p is not None for p in scores(fitted, holes).values())


def test_learns_something(spark):
    rows = spark.range(2000).select(
        F.col("id").cast("string").alias("customer_unique_id"),
        (F.col("id") % 100).alias("days"),
        F.when(F.col("id") % 100 > 60, 1).otherwise(0).alias(LABEL),
        (F.xxhash64("id") % 50).alias("noise"),
    )
    fitted = model.train_model(rows, ["days", "noise"], SMALL, folds=3)
    scored = model.score(fitted, rows)
    assert model.mean_log_loss(scored, F.col(PROBABILITY)) < 0.05
    base = model.base_model(rows, ["days", "noise"], SMALL)
    losses = model.permutation_importance(base, rows, model.positive("probability__"), ["days", "noise"])
    lost = {r[0]: r[1] for r in losses.collect()}
    assert lost["days"] > 0.05 > abs(lost["noise"])
    gains = {r[0]: r[1] for r in model.tree_importance(base, ["days", "noise"]).collect()}
    assert gains["days"] > gains["noise"] and abs(sum(gains.values()) - 1) < 1e-9


def test_search_takes_the_least_loss(parts):
    draws = model.sampled_parameters(2, SMALL_SPACE)
    assert draws == model.sampled_parameters(2, SMALL_SPACE)
    best, results = model.search(parts["train"], parts["val"], split.feature_names(parts["train"]), draws)
    assert [d for d, _ in results] == draws
    assert best == min(results, key=lambda r: r[1])[0]


def test_search_scores_what_would_be_trained(spark):
    rows = spark.range(1500).select(
        F.col("id").cast("string").alias("customer_unique_id"),
        (F.col("id") % 100).alias("days"),
        F.when((F.col("id") % 100 > 60) != (F.xxhash64("id") % 7 == 0), 1).otherwise(0).alias(LABEL),
    )
    train, val = rows.where("customer_unique_id % 3 > 0"), rows.where("customer_unique_id % 3 = 0")
    draws = [SMALL | {"stepSize": rate, "maxIter": rounds} for rate, rounds in ((0.01, 6), (0.05, 6), (0.1, 6), (0.1, 12))]
    _, results = model.search(train, val, ["days"], draws)
    losses = [loss for _, loss in results]
    assert losses == sorted(losses, reverse=True) and len(set(losses)) == 4
    for draw, loss in results:
        fitted = model.base_model(train, ["days"], draw)
        assert fitted.stages[-1].getNumTrees == draw["maxIter"]
        assert model.mean_log_loss(fitted.transform(val), model.positive("probability__")) == pytest.approx(loss, abs=1e-9)


def test_search_space_is_kept():
    for draw in model.sampled_parameters(50):
        for name, (low, high, step) in model.SEARCH_SPACE.items():
            assert low <= draw[name] <= high
            assert step is None or (draw[name] - low) % step == 0


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("customer_unique_id"))
    one = {r[0] for r in model.seeded_sample(df.repartition(3), 100).collect()}
    two = {r[0] for r in model.seeded_sample(df.repartition(11), 100).collect()}
    other = {r[0] for r in model.seeded_sample(df, 100, seed=7).collect()}
    assert len(one) == 100 and one == two != other
    assert model.seeded_sample(df, 5000).count() == 3000


def test_folds_keep_a_person_together(spark):
    df = spark.range(1000).select(F.col("id").alias("customer_unique_id"), F.explode(F.array(F.lit(1), F.lit(2))))
    folds = df.select("customer_unique_id", model.fold_of().alias("fold"))
    assert folds.groupBy("customer_unique_id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").isEmpty()
    assert {r[0] for r in folds.select("fold").distinct().collect()} == {0, 1, 2, 3, 4}


def test_model_contract_matches_the_matrix(parts):
    features = split.features_of(parts["train"])
    expected = contract.blueprint_features(contract.feature_blueprint(features))
    checks = contract.check_contract(expected, parts["test"])
    assert contract.contract_result(checks).first()["is_valid"]


def test_pruned_search_stops_a_bad_draw_and_keeps_full_losses(parts):
    good = SMALL | {"maxIter": 6}
    draws = [good, SMALL | {"maxIter": 6, "stepSize": 0.01, "maxDepth": 1}, good | {"maxDepth": 2}, good | {"subsamplingRate": 0.6}]
    names = split.feature_names(parts["train"])
    best, fits = model.pruned_search(parts["train"], parts["val"], names, draws, cut=2, rungs=3, threads=2)
    _, full = model.search(parts["train"], parts["val"], names, draws, threads=2)
    assert {i for i, rung, _, _ in fits if rung == 0} == {0, 1, 2, 3}
    assert 1 not in {i for i, rung, _, _ in fits if rung > 0}
    last = [f for f in fits if f[1] == 2]
    assert last and all(loss == full[i][1] and rounds == 6 for i, _, rounds, loss in last)
    assert best == draws[min(last, key=lambda f: f[3])[0]]
    assert sum(f[2] for f in fits) < sum(d["maxIter"] for d in draws)
