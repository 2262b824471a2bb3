"""Model evaluation on a long table ``(model_id, y, p, monetary_total)`` and the decision it leads to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import MONEY
from tidemark.functions.scores import campaign_return, expected_value, log_loss_term, squared_error
from tidemark.operators.quantile import exact_quantile

# Where the high-value slice begins, the least return a model needs, and its lead over the current one.
HIGH_VALUE_SHARE = 0.90
MIN_RETURN = 0.05
RETURN_MARGIN = 0.02


def high_value_threshold(df: DataFrame) -> float | None:
    """Money from which a customer is in the high-value slice; None if there is no money column."""
    return exact_quantile(df, MONEY, HIGH_VALUE_SHARE) if MONEY in df.columns else None


def high_value_slice(df: DataFrame, threshold: float | None = None) -> DataFrame:
    threshold = high_value_threshold(df) if threshold is None else threshold
    return df.filter(F.col(MONEY) >= threshold)


def targeted(df: DataFrame) -> DataFrame:
    """Customers worth contacting."""
    return df.filter(expected_value(F.col("p")) > 0)


def evaluation(predictions: DataFrame, threshold: float | None = None) -> DataFrame:
    """Log loss, Brier score overall and in the high-value slice, and campaign return per model, in one pass.

    ``threshold`` is the start of the slice, computed over all rows if not given; all models score the same
    customers, so it is the same for each. Without money or an empty slice the overall Brier score stands in.
    """
    y, p = F.col("y"), F.col("p")
    if threshold is None:
        threshold = high_value_threshold(predictions)
    error = squared_error(y, p)
    in_slice = F.lit(False) if threshold is None else F.col(MONEY) >= threshold
    contacted = expected_value(p) > 0
    totals = predictions.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("test_set_size"),
        F.avg(log_loss_term(y, p)).alias("log_loss"),
        F.avg(error).alias("brier_score"),
        F.avg(F.when(in_slice, error)).alias("slice_brier"),
        F.count_if(contacted).alias("contacted"),
        F.coalesce(F.sum(F.when(contacted, y)), F.lit(0)).alias("contacted_churners"),
    )
    return totals.select(
        "model_id",
        "test_set_size",
        "log_loss",
        "brier_score",
        F.coalesce("slice_brier", "brier_score").alias("high_value_slice_brier_score"),
        "contacted",
        "contacted_churners",
        campaign_return(F.col("contacted"), F.col("contacted_churners")).alias("eroi"),
    )


def decision(metrics: DataFrame, challenger: str, champion: str | None = None) -> DataFrame:
    """Whether the challenger replaces the champion: it needs the least return, and the margin over a champion."""
    current = F.lit(champion).cast("string")
    returns = metrics.agg(
        F.max(F.when(F.col("model_id") == challenger, F.col("eroi"))).alias("challenger_eroi"),
        F.max(F.when(F.col("model_id") == current, F.col("eroi"))).alias("champion_eroi"),
    )
    needed = F.col("champion_eroi") + RETURN_MARGIN
    too_low = F.col("challenger_eroi") < MIN_RETURN
    alone = F.col("champion_eroi").isNull()
    wins = F.col("challenger_eroi") >= needed
    return returns.select(
        F.lit(challenger).alias("challenger_id"),
        F.col("challenger_eroi"),
        F.col("champion_eroi"),
        F.when(too_low, F.lit(False)).when(alone, F.lit(True)).otherwise(wins).alias("approved"),
        F.when(too_low, "below minimum return")
        .when(alone, "no champion")
        .when(wins, "beats champion")
        .otherwise("margin not reached")
        .alias("reason"),
    )
