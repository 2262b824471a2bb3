"""Expressions over labels, probabilities and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the campaign model: price of one contact, value of a kept customer, share of contacts that work.
CAMPAIGN_COST = 10.0
KEPT_VALUE = 500.0
SAVE_RATE = 0.10

# Fixed value: smallest step of a double around 1, the distance probabilities keep from 0 and 1.
PROBABILITY_EPSILON = 2.220446049250313e-16


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def log_loss_term(label: Column, probability: Column) -> Column:
    p = F.least(F.greatest(probability, F.lit(PROBABILITY_EPSILON)), F.lit(1.0 - PROBABILITY_EPSILON))
    return -F.when(label == 1, F.ln(p)).otherwise(F.ln(F.lit(1.0) - p))


def squared_error(label: Column, probability: Column) -> Column:
    gap = probability - label
    return gap * gap


def expected_value(probability: Column) -> Column:
    """What contacting a customer is expected to bring."""
    return probability * KEPT_VALUE * SAVE_RATE - CAMPAIGN_COST


def campaign_return(contacted: Column, lost: Column) -> Column:
    """Return on cost of contacting ``contacted`` customers of whom ``lost`` would have left; 0 for nobody."""
    cost = contacted * CAMPAIGN_COST
    gain = lost * SAVE_RATE * KEPT_VALUE
    return F.when(contacted > 0, (gain - cost) / F.nullif(cost, F.lit(0.0))).otherwise(F.lit(0.0))


def revenue_at_risk(probability: Column, money: Column) -> Column:
    return probability * money
