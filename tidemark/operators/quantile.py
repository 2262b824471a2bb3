"""Exact quantile of a column that does not fit one task.

Spark's exact ``percentile`` keeps every different value in one aggregation buffer. Here a sketch of bounded size
brackets the wanted rank, a second pass counts the rows below the bracket and each value inside it, and where the
values inside are still many the bracket is narrowed again. A bracket that misses the rank is widened, so the result is
exact whatever the sketch says.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
#: Different values that may be looked at on the driver.
FEW_VALUES = 50_000


def _sketched(values: DataFrame, shares: list[float], accuracy: int) -> tuple[int, float, float]:
    """Number of rows, and values at or just outside the two shares."""
    margin = 2.0 / accuracy
    wide = [max(0.0, shares[0] - margin), min(1.0, shares[1] + margin)]
    row = values.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", wide, accuracy).alias("q")).first()
    return row["n"], *(row["q"] or (None, None))


def _counts(values: DataFrame, low: float, high: float, few: int) -> tuple[int, list] | None:
    """Rows below ``low``, and the values from ``low`` to ``high`` in order with their rows; None if these are many."""
    value = F.col("value")
    side = F.when(value < low, -1).when(value > high, 1).otherwise(0)
    grouped = values.groupBy(side.alias("side"), F.when(side == 0, value).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = grouped.limit(few + 3).collect()
    if len(rows) > few + 2:
        return None
    below = sum(r["n"] for r in rows if r["side"] == -1)
    return below, sorted((r["value"], r["n"]) for r in rows if r["side"] == 0)


def _pick(counts: list, below: int, ranks: list[int]) -> list[float]:
    """Values at the ranks that lie among the counted ones."""
    found, end = [], below
    for value, n in counts:
        start, end = end, end + n
        found += [value for rank in ranks if start <= rank < end]
    return found


def exact_quantile(
    df: DataFrame, column: str, share: float, few: int = FEW_VALUES, accuracy: int = SKETCH_ACCURACY
) -> float | None:
    """Quantile with linear interpolation between neighbours; NULLs do not count. None without values."""
    everything = df.select(F.col(column).cast("double").alias("value")).filter(F.col("value").isNotNull())
    total, low, high = _sketched(everything, [share, share], accuracy)
    if not total:
        return None
    position = (total - 1) * share
    ranks = sorted({math.floor(position), math.ceil(position)})
    values, skipped = everything, 0
    while True:
        counted = _counts(values, low, high, few)
        if counted is not None:
            below, counts = counted
            found = _pick(counts, skipped + below, ranks)
            if len(found) == len(ranks):
                break
            low, high = (-math.inf, high) if ranks[0] < skipped + below else (low, math.inf)
            continue
        inside = F.col("value").between(low, high)
        sizes = values.agg(
            F.count(F.lit(1)).alias("all"),
            F.count_if(F.col("value") < low).alias("below"),
            F.count_if(inside).alias("inside"),
        ).first()
        start = skipped + sizes["below"]
        if not start <= ranks[0] <= ranks[-1] < start + sizes["inside"]:
            low, high = (-math.inf, high) if ranks[0] < start else (low, math.inf)
            continue
        if sizes["inside"] == sizes["all"]:
            accuracy = min(10 * accuracy, 1_000_000_000)
        values, skipped = values.filter(inside), start
        shares = [(ranks[0] - start) / sizes["inside"], (ranks[-1] - start + 1) / sizes["inside"]]
        _, low, high = _sketched(values, shares, accuracy)
    return found[0] + (found[-1] - found[0]) * (position - ranks[0])
