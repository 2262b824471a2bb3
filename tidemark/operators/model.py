"""Encoding, boosted trees, calibration, scoring and importance with ``pyspark.ml``.

A trained model is one ``PipelineModel`` from raw feature columns to ``predicted_probability``; it is stored and loaded
as such. Training data is read many times: pass tables that are stored, or cached where they fit.
"""

from __future__ import annotations

import random
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, TargetEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import LABEL, PERSON, PROBABILITY
from tidemark.functions.scores import log_loss_term
from tidemark.operators.report import with_revenue_at_risk
from tidemark.operators.split import class_balance
from tidemark.operators.numbering import numbered
from tidemark.session import shared_folder

# Seed, calibration folds, size of the importance sample, number of search trials.
SEED = 42
FOLDS = 5
SAMPLE_ROWS = 2000
TRIALS = 30

#: Text values meet the trees as the target rate of one of so many hash slots, so no model grows with its categories.
SLOTS = 1 << 16
#: Rows that the overall rate counts for in the rate of a slot.
SMOOTHING = 10.0

CODE = "__code"
WEIGHT = "__weight"


def text_features(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]


def category_codes(train: DataFrame, column: str) -> DataFrame:
    """(value, code): the text values of a column in alphabetical order, numbered from 0 without a one-task window."""
    values = train.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    return numbered(values, ["value"], "code")


def with_codes(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Adds the code of ``column``; unknown values and NULL share the code after the last."""
    known = codes.select(F.col("value").alias("__value"), F.col("code").alias("__known"))
    last = codes.count()
    coded = df.join(known, F.col(column) == F.col("__value"), "left")
    return coded.withColumn(column + CODE, F.coalesce("__known", F.lit(last)).cast("int")).drop("__value", "__known")


def _slots(names: Sequence[str]) -> SQLTransformer:
    """The hash slot of each text; NULL has one of its own."""
    slots = ", ".join(f"cast(if({c} IS NULL, {SLOTS}, pmod(xxhash64({c}), {SLOTS})) AS double) AS {c}__slot" for c in names)
    return SQLTransformer(statement=f"SELECT *, {slots} FROM __THIS__")


def category_rates(train: DataFrame, names: Sequence[str]) -> list:
    """Stages from texts to the smoothed target rate of their slot; slots not seen in training get the overall rate."""
    slots = _slots(names)
    # The encoder marks its output as categories; a computed copy is a plain number to the trees.
    rates = ", ".join(f"{c}{CODE} + 0.0D AS {c}__rate" for c in names)
    plain = SQLTransformer(statement=f"SELECT *, {rates} FROM __THIS__")
    return [slots, _rate_encoder(names).fit(slots.transform(train)), plain]


def _rate_encoder(names: Sequence[str]) -> TargetEncoder:
    return TargetEncoder(
        inputCols=[c + "__slot" for c in names], outputCols=[c + CODE for c in names], labelCol=LABEL,
        targetType="binary", handleInvalid="keep", smoothing=SMOOTHING,
    )


def encode_training(encoder: PipelineModel, train: DataFrame, features: Sequence[str], folds: int = FOLDS) -> DataFrame:
    """``train`` encoded for fitting. The rate of a row's text comes from the other folds, so no row tells its own label."""
    texts = text_features(train, features)
    if not texts:
        return encoder.transform(train)
    rows = encoder.stages[0].transform(train.withColumn("__fold", fold_of(folds=folds)))
    parts = []
    for k in range(folds):
        own, others = rows.where(F.col("__fold") == k), rows.where(F.col("__fold") != k)
        if others.isEmpty():
            others = own
        parts.append(_rate_encoder(texts).fit(others).transform(own))
    encoded = reduce(DataFrame.unionByName, parts)
    for stage in encoder.stages[2:]:
        encoded = stage.transform(encoded)
    return encoded.drop("__fold")


def _missing_numbers(names: Sequence[str]) -> SQLTransformer:
    """Each number with 0 for NULL, and a flag that says so. A tree can then send missing values either way."""
    filled = ", ".join(f"coalesce(cast({c} AS double), 0.0D) AS {c}__value" for c in names)
    flags = ", ".join(f"cast({c} IS NULL AS double) AS {c}__missing" for c in names)
    return SQLTransformer(statement=f"SELECT *, {filled}, {flags} FROM __THIS__")


def encoding(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """From feature columns to the vector ``features__vector``, learned from ``train``."""
    texts = text_features(train, features)
    numbers = [c for c in features if c not in texts]
    inputs = [c + "__rate" for c in texts] + [c + s for s in ("__value", "__missing") for c in numbers]
    stages = category_rates(train, texts) if texts else []
    stages += [_missing_numbers(numbers)] if numbers else []
    return PipelineModel(stages + [VectorAssembler(inputCols=inputs, outputCol="features__vector")])


# The search space, as lowest value, highest value and step (None: any value between). The names are those of
# the trees' parameters; featureSubsetStrategy is a share of the columns.
SEARCH_SPACE = {
    "maxIter": (100, 500, 50),
    "stepSize": (0.01, 0.1, None),
    "maxDepth": (3, 7, 1),
    "minInstancesPerNode": (1, 10, 1),
    "subsamplingRate": (0.6, 1.0, None),
    "featureSubsetStrategy": (0.6, 1.0, None),
    "minInfoGain": (0.0, 0.005, None),
}
LOG_SCALE = {"stepSize"}


def sampled_parameters(trials: int, space: dict = SEARCH_SPACE, seed: int = SEED) -> list[dict]:
    """Seeded draws from the search space."""
    rng = random.Random(seed)

    def draw(name, low, high, step):
        if step is not None:
            return rng.randrange(low, high + 1, step)
        if name in LOG_SCALE:
            return low * (high / low) ** rng.random()
        return rng.uniform(low, high)

    return [{name: draw(name, *limits) for name, limits in space.items()} for _ in range(trials)]


def boosted_trees(parameters: dict, tag: str = "") -> GBTClassifier:
    share = str(round(parameters["featureSubsetStrategy"], 4))
    trees = GBTClassifier(
        featuresCol="features__vector", labelCol=LABEL, weightCol=WEIGHT, predictionCol=f"prediction__{tag}", seed=SEED,
        **parameters | {"featureSubsetStrategy": share},
    )
    return trees.setProbabilityCol(f"probability__{tag}").setRawPredictionCol(f"raw__{tag}")


def with_class_weight(df: DataFrame, positive_weight: float) -> DataFrame:
    return df.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, positive_weight).otherwise(1.0))


def positive(probability_column: str):
    return vector_to_array(F.col(probability_column))[1]


def mean_log_loss(scored: DataFrame, probability) -> float:
    return scored.agg(F.avg(log_loss_term(F.col(LABEL), probability)).alias("loss")).first()["loss"]


def at_a_time(spark: SparkSession, threads: int, function: Callable, items: Sequence) -> list:
    """Results of ``function`` for all items in order, several running at a time."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(inheritable_thread_target(spark)(function), items))


def search(
    train: DataFrame, val: DataFrame, features: Sequence[str], draws: list[dict], threads: int = 1
) -> tuple[dict, list[tuple]]:
    """The draw with the least log loss on ``val``, and all draws with their loss.

    Each draw is fitted to ``train`` with all its rounds, as the model that would be trained with it.
    """
    encoded = _encoded_for_search(train, val, features)

    def trial(draw: dict) -> tuple[dict, float]:
        return draw, _validation_loss(encoded, draw)

    try:
        results = at_a_time(train.sparkSession, threads, trial, draws)
    finally:
        encoded.unpersist()
    return min(results, key=lambda r: r[1])[0], results


def _encoded_for_search(train: DataFrame, val: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows to fit and rows to judge by, encoded once for all draws."""
    shared_folder(train.sparkSession)  # where boosting rounds cut their lineage
    encoder = encoding(train, features)
    weight = class_balance(train).first()["positive_weight"]
    columns = ["features__vector", LABEL, WEIGHT, "is_val"]
    fitting = with_class_weight(encode_training(encoder, train, features), weight).withColumn("is_val", F.lit(False))
    judging = with_class_weight(encoder.transform(val), weight).withColumn("is_val", F.lit(True))
    return fitting.select(*columns).unionByName(judging.select(*columns)).persist()


def _validation_loss(encoded: DataFrame, draw: dict) -> float:
    scored = boosted_trees(draw).fit(encoded.filter("NOT is_val")).transform(encoded.filter("is_val"))
    return mean_log_loss(scored, positive("probability__"))


def pruned_search(
    train: DataFrame, val: DataFrame, features: Sequence[str], draws: list[dict], cut: int = 3, rungs: int = 3, threads: int = 1
) -> tuple[dict, list[tuple]]:
    """The draw that survives successive halving, and all fits as (draw's place, rung, rounds, loss on ``val``).

    At the first of ``rungs`` rungs every draw is fitted with ``1 / cut ** (rungs - 1)`` of its rounds; the best ``1 / cut`` of them,
    by log loss, go on to ``cut`` times as many rounds, and so on, until the last rung has all rounds. Ties go to the earlier draw.
    Boosting cannot be taken up again in ``pyspark.ml``, so a rung fits anew; with the same seed the rounds are those that came
    before, so a draw of the last rung has the loss of a full fit. With ``n`` equal draws a rung costs ``1 / cut ** (rungs - 1)``
    of the full search: a third of it in all by default.
    """
    encoded = _encoded_for_search(train, val, features)
    alive, fits = list(range(len(draws))), []
    try:
        for rung in range(rungs):
            share = cut ** (rungs - 1 - rung)

            def trial(i: int, rung: int = rung, share: int = share) -> tuple:
                rounds = max(1, draws[i]["maxIter"] // share)
                return i, rung, rounds, _validation_loss(encoded, draws[i] | {"maxIter": rounds})

            done = at_a_time(train.sparkSession, threads, trial, alive)
            fits += done
            best = sorted(done, key=lambda r: (r[3], r[0]))
            keep = len(best) if rung == rungs - 1 else max(1, -(-len(best) // cut))
            alive = sorted(r[0] for r in best[:keep])
    finally:
        encoded.unpersist()
    return draws[best[0][0]], fits


def fold_of(person: str = PERSON, folds: int = FOLDS):
    """All rows of a person share a fold."""
    return F.pmod(F.xxhash64(F.col(person)), F.lit(folds)).cast("int")


def train_model(
    train: DataFrame, features: Sequence[str], parameters: dict, folds: int = FOLDS, threads: int = 1
) -> PipelineModel:
    """Boosted trees with isotonic calibration, averaged over folds, as one scoring model.

    Of each fold, trees are fitted to the other folds and calibrated on the fold itself.
    """
    shared_folder(train.sparkSession)  # where boosting rounds cut their lineage
    encoder = encoding(train, features)
    weight = class_balance(train).first()["positive_weight"]
    encoded = with_class_weight(encode_training(encoder, train, features), weight)
    encoded = encoded.select("features__vector", LABEL, WEIGHT, fold_of(folds=folds).alias("fold")).persist()

    def fold(k: int) -> list:
        trees = boosted_trees(parameters, str(k)).fit(encoded.filter(F.col("fold") != k))
        held_out = trees.transform(encoded.filter(F.col("fold") == k))
        # Equal scores are merged before the isotonic fit, which gives the same curve from fewer points.
        points = held_out.groupBy(positive(f"probability__{k}").alias("score")).agg(
            F.avg(LABEL).alias("rate"), F.count(F.lit(1)).cast("double").alias("rows")
        )
        curve = IsotonicRegression(featuresCol="score", labelCol="rate", weightCol="rows").fit(points)
        curve = curve.setFeaturesCol(f"probability__{k}").setFeatureIndex(1).setPredictionCol(f"calibrated__{k}")
        return [trees, curve]

    try:
        fitted = at_a_time(train.sparkSession, threads, fold, range(folds))
    finally:
        encoded.unpersist()
    stages = [*encoder.stages, *(stage for pair in fitted for stage in pair)]
    mean = " + ".join(f"calibrated__{k}" for k in range(folds))
    stages.append(SQLTransformer(statement=f"SELECT *, ({mean}) / {folds} AS {PROBABILITY} FROM __THIS__"))
    return PipelineModel(stages)


def base_model(train: DataFrame, features: Sequence[str], parameters: dict) -> PipelineModel:
    """Encoding and uncalibrated trees fitted to all of ``train``."""
    shared_folder(train.sparkSession)  # where boosting rounds cut their lineage
    encoder = encoding(train, features)
    weight = class_balance(train).first()["positive_weight"]
    encoded = with_class_weight(encode_training(encoder, train, features), weight)
    encoded = encoded.select("features__vector", LABEL, WEIGHT).persist()
    try:
        trees = boosted_trees(parameters).fit(encoded)
    finally:
        encoded.unpersist()
    return PipelineModel([*encoder.stages, trees])


def score(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    """The matrix with probability and revenue at risk. An empty matrix gives the same columns without rows."""
    scored = model.transform(matrix).select(*matrix.columns, PROBABILITY)
    return with_revenue_at_risk(scored)


def seeded_sample(df: DataFrame, rows: int = SAMPLE_ROWS, keys: Sequence[str] = (PERSON,), seed: int = SEED) -> DataFrame:
    """At most ``rows`` rows, the same for the same seed however the data is partitioned."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(key.cast("binary")), *keys).limit(rows)


def permutation_importance(model: PipelineModel, rows: DataFrame, probability, features: Sequence[str]) -> DataFrame:
    """Rise of log loss when the values of one feature are dealt to other rows, per feature.

    All of ``rows`` count. Every feature is dealt in the same shuffled order, by a numbering that no single task makes.
    """
    spark = rows.sparkSession
    key = F.md5(F.concat_ws("|", F.col(PERSON).cast("string"), F.struct(*features).cast("string")).cast("binary"))
    order = "__" + uuid.uuid4().hex
    placed = numbered(rows.withColumn(order, key), [order], "nth").drop(order)
    count = placed.count()
    base = mean_log_loss(model.transform(placed), probability)
    results = []
    for i, name in enumerate(features):
        dealt = placed.select(F.pmod(F.col("nth") + F.lit(count // 2 + i), F.lit(count)).alias("nth"), F.col(name).alias(name))
        mixed = placed.drop(name).join(dealt, "nth")
        results.append((name, mean_log_loss(model.transform(mixed), probability) - base))
    return spark.createDataFrame(results, "feature string, loss_increase double")


def tree_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Share of each feature in the gain of all splits, its value and missing flag together."""
    trees = next(s for s in model.stages if hasattr(s, "featureImportances"))
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    shares = trees.featureImportances.toArray()
    rows = [
        (name, float(sum(w for c, w in zip(inputs, shares) if c.rsplit("__", 1)[0] == name))) for name in features
    ]
    return SparkSession.active().createDataFrame(rows, "feature string, gain_share double")
