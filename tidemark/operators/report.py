"""Scores turned into a ranked report and a log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import AT_RISK, MONEY, PERSON, PROBABILITY, REPORT_COLUMNS
from tidemark.functions.scores import revenue_at_risk
from tidemark.functions.times import utc_now

# Fixed value: the probability from which a customer is flagged.
FLAG_THRESHOLD = 0.5


def with_revenue_at_risk(scored: DataFrame) -> DataFrame:
    """Probability times money, 0.0 where the matrix has no money."""
    if MONEY not in scored.columns:
        return scored.withColumn(AT_RISK, F.lit(0.0))
    return scored.withColumn(AT_RISK, revenue_at_risk(F.col(PROBABILITY), F.col(MONEY)))


def flagged(scored: DataFrame, threshold: float = FLAG_THRESHOLD) -> DataFrame:
    return scored.filter(F.col(PROBABILITY) >= threshold)


def business_report(scored: DataFrame, threshold: float = FLAG_THRESHOLD) -> DataFrame:
    """Flagged customers, most money at risk first; the customer id orders equal amounts."""
    present = [c for c in REPORT_COLUMNS if c in scored.columns]
    order = [F.desc(AT_RISK)] + ([F.asc(PERSON)] if PERSON in scored.columns else [])
    return flagged(scored, threshold).select(*present).orderBy(*order)


def report_totals(scored: DataFrame, threshold: float = FLAG_THRESHOLD) -> DataFrame:
    """Scored customers, flagged customers and their revenue at risk."""
    is_flagged = F.col(PROBABILITY) >= threshold
    risk = F.round(F.sum(F.when(is_flagged, F.col(AT_RISK))), 2)
    return scored.agg(
        F.count(F.lit(1)).alias("total_customers_scored"),
        F.count_if(is_flagged).alias("total_churners_flagged"),
        F.coalesce(risk, F.lit(0.0)).alias("total_revenue_at_risk"),
    )


def telemetry(scored: DataFrame, run_id: str, model_id: str) -> DataFrame:
    """Every scored row with the run and the model it came from."""
    return scored.withColumns(
        {
            "inference_run_id": F.lit(run_id),
            "timestamp_utc": utc_now(),
            "champion_model_id": F.lit(model_id),
        }
    )
