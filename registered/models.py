"""Evaluation, decision, and the model operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered import sql
from registered.features import matrix, panel
from registered.registry import query
from registered.sql import with_base
from registered.storage import split_panel
from tidemark.columns import LABEL, PROBABILITY, SPLITS
from tidemark.functions import scores
from tidemark.operators import attribution, evaluate, model, split
from tidemark.operators.quantile import exact_quantile
from tidemark.session import scratch_path
from tidemark.sources import sample_data as data
from tidemark.sources import sinks

# Small settings: what is trained here shows the operators, not a good model.
SMALL = {
    "maxIter": 4, "stepSize": 0.1, "maxDepth": 3, "minInstancesPerNode": 1, "subsamplingRate": 0.9,
    "featureSubsetStrategy": 0.9, "minInfoGain": 0.0,
}
SMALL_SPACE = model.SEARCH_SPACE | {"maxIter": (2, 4, 1), "maxDepth": (2, 3, 1)}


def predictions(spark, folder):
    """Fixed scores of two models on the test split, which is written first because evaluation reads it several times."""
    path = scratch_path(spark, "test")
    split.one_split(split_panel(spark, folder), "test").write.parquet(path)
    test = spark.read.parquet(path)
    days = F.col("recency_days").cast("double")

    def part(model_id, half):
        p = days / (days + half)
        return test.select(
            F.lit(model_id).alias("model_id"), F.col(LABEL).alias("y"), p.alias("p"), "monetary_total"
        )

    return part("challenger", 90.0).unionByName(part("champion", 400.0))


def _evaluated(columns: str) -> str:
    return with_base(f"SELECT {columns} FROM metrics", sql.PANEL, sql.PREDICTIONS, sql.EVALUATION)


ROUNDED = ["log_loss", "brier_score", "high_value_slice_brier_score", "eroi"]
ALL_METRICS = "model_id, test_set_size, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in ROUNDED) + (
    ", contacted, contacted_churners"
)


def metrics(spark, folder):
    rows = evaluate.evaluation(predictions(spark, folder))
    return rows.withColumns({c: F.round(c, 6) for c in ROUNDED})


@query("m11_evaluation", _evaluated(ALL_METRICS))
def evaluation(spark, folder):
    return metrics(spark, folder)


@query("a16_log_loss", _evaluated("model_id, ROUND(log_loss, 6) AS log_loss"))
def log_loss(spark, folder):
    loss = F.avg(scores.log_loss_term(F.col("y"), F.col("p")))
    return predictions(spark, folder).groupBy("model_id").agg(F.round(loss, 6).alias("log_loss"))


@query(
    "a17_brier_scores",
    _evaluated("model_id, ROUND(brier_score, 6) AS brier_score, ROUND(high_value_slice_brier_score, 6) AS slice"),
)
def brier_scores(spark, folder):
    return metrics(spark, folder).select(
        "model_id", "brier_score", F.col("high_value_slice_brier_score").alias("slice")
    )


@query("a18_campaign_return", _evaluated("model_id, contacted, contacted_churners, ROUND(eroi, 6) AS eroi"))
def campaign_return(spark, folder):
    return metrics(spark, folder).select("model_id", "contacted", "contacted_churners", "eroi")


@query(
    "a15_exact_quantile",
    "SELECT COUNT(*) AS orders, ROUND(quantile_cont(o_totalprice, 0.9), 6) AS q90 FROM orders",
)
def quantile(spark, folder):
    orders = data.table(spark, folder, "orders")
    q90 = exact_quantile(orders, "o_totalprice", 0.9)
    return orders.agg(F.count(F.lit(1)).alias("orders"), F.round(F.lit(q90), 6).alias("q90"))


@query(
    "p10_high_value_slice",
    with_base(
        "SELECT customer_unique_id, monetary_total FROM matrix "
        "WHERE monetary_total >= (SELECT quantile_cont(monetary_total, 0.9) FROM matrix)",
        sql.MATRIX,
    ),
)
def high_value_slice(spark, folder):
    return evaluate.high_value_slice(matrix(spark, folder)).select("customer_unique_id", "monetary_total")


@query(
    "p11_targeted_customers",
    with_base(
        f"SELECT customer_unique_id, {sql.PROBABILITY} AS p FROM matrix "
        f"WHERE {sql.PROBABILITY} * 500e0 * 0.1e0 - 10e0 > 0",
        sql.MATRIX,
    ),
)
def targeted_customers(spark, folder):
    days = F.col("recency_days").cast("double")
    rows = matrix(spark, folder).select("customer_unique_id", (days / (days + 90.0)).alias("p"))
    return evaluate.targeted(rows)


@query(
    "m12_decision",
    with_base(
        """SELECT 'challenger' AS challenger_id, ROUND(a.eroi, 6) AS challenger_eroi, ROUND(b.eroi, 6) AS champion_eroi,
        a.eroi >= 0.05 AND a.eroi >= b.eroi + 0.02 AS approved,
        CASE WHEN a.eroi < 0.05 THEN 'below minimum return' WHEN a.eroi >= b.eroi + 0.02 THEN 'beats champion'
             ELSE 'margin not reached' END AS reason
        FROM metrics a, metrics b WHERE a.model_id = 'challenger' AND b.model_id = 'champion'""",
        sql.PANEL, sql.PREDICTIONS, sql.EVALUATION,
    ),
)
def decision(spark, folder):
    rows = evaluate.decision(evaluate.evaluation(predictions(spark, folder)), "challenger", "champion")
    return rows.withColumns({c: F.round(c, 6) for c in ("challenger_eroi", "champion_eroi")})


# --- encoding and models


def stored_split(spark, folder):
    """Train, validation and test rows, written once because training reads them many times."""
    rows = split_panel(spark, folder)
    path = scratch_path(spark, "splits")
    sinks.write_splits(rows, path)
    stored = spark.read.parquet(path).select(*rows.columns)
    return [split.one_split(stored, s) for s in SPLITS]


@query(
    "m3_category_codes",
    with_base(
        """SELECT customer_unique_id, snapshot_date, customer_state,
                  CAST(COALESCE(code, (SELECT COUNT(*) FROM codes)) AS INTEGER) AS code
           FROM split LEFT JOIN codes USING (customer_state)""",
        sql.PANEL,
        sql.SPLIT,
        """codes AS (SELECT customer_state, DENSE_RANK() OVER (ORDER BY customer_state) - 1 AS code
                     FROM (SELECT DISTINCT customer_state FROM split WHERE split = 'train'))""",
    ),
)
def category_codes(spark, folder):
    rows = split_panel(spark, folder)
    codes = model.category_codes(split.one_split(rows, "train"), "customer_state")
    return model.with_codes(rows, codes, "customer_state").select(
        "customer_unique_id", "snapshot_date", "customer_state", F.col("customer_state" + model.CODE).alias("code")
    )


@query("f12_unknown_category", with_base("SELECT customer_unique_id, CAST(n AS INTEGER) AS code FROM matrix, "
       "(SELECT COUNT(DISTINCT customer_state) AS n FROM matrix)", sql.MATRIX))
def unknown_category(spark, folder):
    """States the encoder never saw, and missing ones, get the code after the last."""
    rows = matrix(spark, folder)
    codes = model.category_codes(rows, "customer_state")
    odd = F.when(F.col("customer_unique_id") % 2 == 0, F.concat(F.lit("new "), F.col("customer_state")))
    coded = model.with_codes(rows.withColumn("customer_state", odd), codes, "customer_state")
    return coded.select("customer_unique_id", F.col("customer_state" + model.CODE).alias("code"))


@query(
    "o4_seeded_sample",
    with_base(
        "SELECT customer_unique_id, snapshot_date FROM panel "
        "ORDER BY md5(customer_unique_id::VARCHAR || '|' || snapshot_date || '|42'), customer_unique_id, "
        "snapshot_date LIMIT 2000",
        sql.PANEL,
    ),
)
def seeded_sample(spark, folder):
    keys = ["customer_unique_id", "snapshot_date"]
    return model.seeded_sample(panel(spark, folder), keys=keys).select(*keys)


@query("m4_parameter_search")
def parameter_search(spark, folder):
    train, val, _ = stored_split(spark, folder)
    draws = model.sampled_parameters(3, SMALL_SPACE)
    _, results = model.search(train, val, split.feature_names(train), draws)
    rows = [(i, draw["maxIter"], draw["maxDepth"], draw["stepSize"], loss) for i, (draw, loss) in enumerate(results)]
    return spark.createDataFrame(rows, "trial int, rounds int, depth int, learning_rate double, val_log_loss double")


@query("m4_pruned_search")
def pruned_search(spark, folder):
    """Six draws on two rungs: two of them are fitted with all their rounds."""
    train, val, _ = stored_split(spark, folder)
    draws = model.sampled_parameters(6, SMALL_SPACE | {"maxIter": (3, 9, 3)})
    _, fits = model.pruned_search(train, val, split.feature_names(train), draws, rungs=2, threads=2)
    return spark.createDataFrame(fits, "trial int, rung int, rounds int, val_log_loss double")


@query("m5_boosted_trees")
def boosted_trees(spark, folder):
    train, val, _ = stored_split(spark, folder)
    fitted = model.base_model(train, split.feature_names(train), SMALL)
    scored = fitted.transform(val)
    return scored.select("customer_unique_id", LABEL, model.positive("probability__").alias("probability"))


def _calibrated(spark, folder):
    train, val, test = stored_split(spark, folder)
    fitted = model.train_model(train, split.feature_names(train), SMALL, folds=3)
    return fitted, train, val, test


@query("m6_calibrated_scores")
def calibrated_scores(spark, folder):
    fitted, _, val, _ = _calibrated(spark, folder)
    return model.score(fitted, val).select("customer_unique_id", LABEL, PROBABILITY)


@query("m7_stored_model")
def stored_model(spark, folder):
    """Encoder, trees and calibration stored and loaded as one model."""
    from pyspark.ml import PipelineModel

    fitted, _, _, test = _calibrated(spark, folder)
    path = scratch_path(spark, "model")
    fitted.write().save(path)
    return model.score(PipelineModel.load(path), test).select("customer_unique_id", PROBABILITY)


@query("m8_feature_importance")
def feature_importance(spark, folder):
    train, val, _ = stored_split(spark, folder)
    names = split.feature_names(train)
    fitted = model.base_model(train, names, SMALL)
    dealt = model.permutation_importance(fitted, val, model.positive("probability__"), names)
    return dealt.join(model.tree_importance(fitted, names), "feature")


@query(
    "m8_row_attributions",
    with_base(
        """SELECT customer_unique_id, snapshot_date, TRUE AS adds_up FROM split
           WHERE split = 'val'""",
        sql.PANEL, sql.SPLIT,
    ),
)
def row_attributions(spark, folder):
    """Shapley attributions of every validation row: with the base value they add up to the raw score."""
    train, val, _ = stored_split(spark, folder)
    names = split.feature_names(train)
    fitted = model.base_model(train, names, SMALL | {"maxIter": 20})
    keys = ["customer_unique_id", "snapshot_date"]
    rows = attribution.attributions(fitted, val, names, keys)
    total = sum((F.col(n) for n in names), F.col("base_value"))
    return rows.select(*keys, (F.abs(total - F.col("raw_score")) < 1e-9).alias("adds_up"))


@query("m8_mean_attributions")
def mean_attributions(spark, folder):
    train, val, _ = stored_split(spark, folder)
    names = split.feature_names(train)
    fitted = model.base_model(train, names, SMALL | {"maxIter": 20})
    return attribution.mean_attributions(attribution.attributions(fitted, val, names, ["customer_unique_id"]), names)


@query("m9_batch_scores")
def batch_scores(spark, folder):
    fitted, _, _, _ = _calibrated(spark, folder)
    return model.score(fitted, matrix(spark, folder))


@query(
    "m9_scored_rows",
    with_base("SELECT *, TRUE AS is_probability, TRUE AS is_money_at_risk FROM matrix", sql.MATRIX),
)
def scored_rows(spark, folder):
    """Every customer once with unchanged features, a probability, and money at risk that follows from it."""
    fitted, _, _, _ = _calibrated(spark, folder)
    rows = matrix(spark, folder)
    scored = model.score(fitted, rows)
    p = F.col(PROBABILITY)
    return scored.select(
        *rows.columns,
        p.between(0.0, 1.0).alias("is_probability"),
        F.col("revenue_at_risk").eqNullSafe(p * F.col("monetary_total")).alias("is_money_at_risk"),
    )


@query(
    "m7_loaded_model_scores_alike",
    with_base("SELECT customer_unique_id, TRUE AS same FROM split WHERE split = 'test'", sql.PANEL, sql.SPLIT),
)
def loaded_model_scores_alike(spark, folder):
    """A model in memory and the same model loaded from storage give each test customer the same probability."""
    from pyspark.ml import PipelineModel

    fitted, _, _, test = _calibrated(spark, folder)
    path = scratch_path(spark, "model")
    fitted.write().save(path)
    again = model.score(PipelineModel.load(path), test).select("customer_unique_id", F.col(PROBABILITY).alias("again"))
    both = model.score(fitted, test).join(again, "customer_unique_id")
    return both.select("customer_unique_id", (F.col(PROBABILITY) == F.col("again")).alias("same"))
