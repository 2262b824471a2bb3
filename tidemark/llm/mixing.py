"""Mixing sources to target weights by entropy balancing.

Every source gets a target number of words. Among all rates of taking documents that meet the targets, the ones nearest to
taking each document once (in relative entropy, up to the most copies) are exponential in the size of the document; Newton's
method finds the multiplier of each source. Rates become whole copies by a threshold per source and size class, from the
largest class to the smallest, so that smaller documents make up for what larger ones could not be split into.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import n_words, stored

WEIGHTS = (5, 2, 1)
#: No source gives more than this many times its words, and no document is taken more often.
MOST_COPIES = 3
#: Thresholds are chosen among so many steps per source and size class.
BINS = 256
#: Newton's iterations end when every source meets its target to this share, or after ROUNDS.
TOLERANCE, ROUNDS = 1e-9, 60


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with ``place``, their number in code point order, null last. No task sees more than its range of sources."""
    spark = sources.sparkSession
    parts = max(1, spark.sparkContext.defaultParallelism)
    keys = [F.isnull("source"), F.col("source")]
    ordered = sources.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    numbered = stored(ordered.withColumn("id", F.monotonically_increasing_id()), "mix-ordered")
    part = F.shiftright("id", 33)
    # One row per range: at most as many as there are partitions.
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored(sizes.select("part", F.coalesce(before, F.lit(0)).alias("before")), "mix-offsets")
    within = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    joined = numbered.withColumn("part", part).join(F.broadcast(offsets), "part")
    return joined.withColumn("place", F.col("before") + within).drop("part", "before", "id")


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Sources (source, source_size) with their target: min(most * size, level * weight), where the level uses all words up.

    The level is found by filling: sources above their limit are set to it, and the rest is shared by weight again. The
    driver gets a few sums per round.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = stored(ranked(sources).withColumn("weight", weight), "mix-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = (F.lit(level) * F.col("weight") > most * F.col("source_size")) if capped >= 0 else F.lit(False)
        sums = weighed.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, most * F.col("source_size"))).alias("words"), F.sum(F.when(~full, F.col("weight"))).alias("w")
        ).first()
        if sums["n"] == capped or not sums["w"]:
            break
        capped, level = sums["n"], (total - (sums["words"] or 0)) / sums["w"]
    target = F.least((most * F.col("source_size")).cast("double"), F.lit(float(level)) * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def rate(multiplier: Column, size: Column, most: int) -> Column:
    return F.least(F.exp(F.least(multiplier * size, F.lit(50.0))), F.lit(float(most)))


def multipliers(sizes: DataFrame, targets: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(skey, multiplier, scale) such that the documents of each source, taken at their rates, have its target of words.

    ``sizes`` (skey, size, n) counts the documents of a source by size, all that rates depend on; ``targets`` is (skey,
    source_size, target). The expected words grow with the multiplier; a bracket, kept for each source, catches Newton steps
    that overshoot where rates are limited.
    """
    counted = sizes.where("size > 0")
    mean = F.sum(F.col("size") * F.col("n")) / F.sum("n")
    scales = counted.groupBy("skey").agg(mean.alias("scale"))
    state = targets.join(scales, "skey").select(
        "skey", "target", "scale", F.lit(0.0).alias("x"), F.lit(-1e9).alias("low"), F.lit(1e9).alias("high"), F.lit(1.0).alias("miss")
    )
    state = stored(state, "mix-state")
    for _ in range(ROUNDS):
        scaled = F.col("size") / F.col("scale")
        taken = rate(F.col("x"), scaled, most)
        moving = F.when(taken < most, taken * scaled).otherwise(0.0)
        both = counted.join(state, "skey")
        sums = both.groupBy("skey").agg(
            F.sum(F.col("n") * F.col("size") * taken).alias("words"), F.sum(F.col("n") * F.col("size") * moving).alias("slope")
        )
        gap = F.col("words") - F.col("target")
        low, high = F.when(gap < 0, F.col("x")).otherwise(F.col("low")), F.when(gap > 0, F.col("x")).otherwise(F.col("high"))
        step = F.when(F.col("slope") > 0, F.col("x") - gap / F.col("slope"))
        new = F.least(F.greatest(step, F.col("x") - 4), F.col("x") + 4)
        # A step out of the bracket is replaced by its middle, or by a long step where one side is still open.
        middle = (
            F.when((F.col("low") > -1e9) & (F.col("high") < 1e9), (F.col("low") + F.col("high")) / 2)
            .when(F.col("gap") < 0, 2 * F.abs("x") + 1)
            .otherwise(-2 * F.abs("x") - 1)
        )
        moved = state.join(sums, "skey").withColumns({"gap": gap, "low": low, "high": high, "new": new})
        inside = F.col("new").isNotNull() & (F.col("new") > F.col("low")) & (F.col("new") < F.col("high"))
        miss = F.abs("gap") / F.greatest("target", F.lit(1.0))
        done = (miss <= TOLERANCE) | (F.col("high") - F.col("low") < 1e-13)
        moved = moved.select(
            "skey", "target", "scale", F.when(done, F.col("x")).when(inside, F.col("new")).otherwise(middle).alias("x"), "low", "high",
            F.when(done, 0.0).otherwise(miss).alias("miss"),
        )
        state = stored(moved, "mix-state")
        if not (state.agg(F.max("miss")).first()[0] or 0) > 0:
            break
    return state.select("skey", F.col("x").alias("multiplier"), "scale")


def size_class(size: Column) -> Column:
    """Size class of a document: the number of binary digits of its size."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def thresholds(rows: pd.DataFrame) -> pd.DataFrame:
    """Per source: for each size class the number of steps that round up, chosen from the largest class to the smallest.

    A pandas function over at most BINS rows per class: the words that each step would add, and the words expected.
    """
    owed, out = 0.0, []
    for digits, part in rows.sort_values("size_class", ascending=False).groupby("size_class", sort=False):
        part = part.sort_values("step")
        owed += float(part["expected"].sum())
        gains = part["words"].cumsum().to_numpy()
        best = int(abs(gains - owed).argmin()) + 1 if len(gains) and abs(gains - owed).min() < abs(owed) else 0
        chosen = int(part["step"].iloc[best - 1]) if best else -1
        owed -= float(gains[best - 1]) if best else 0.0
        out.append((rows["skey"].iloc[0], digits, chosen))
    return pd.DataFrame(out, columns=["skey", "size_class", "chosen"])


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """One row per input row: id, size, source_size, target, rate, copies and taken = copies * size.

    The size is the number of words, 0 for null. Sources rank by code point, null last, and weigh ``weights`` in turn; they
    share all words, but none gets more than ``most`` times its own. Which of two documents of equal rate is rounded up
    follows from a hash of id and text, so reruns agree; rows with equal id and text get equal copies. Documents without
    words are taken once (0 words). Other columns are ignored.
    """
    sized = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), n_words(text_column).alias("size"),
        F.xxhash64(F.isnull(id_column), id_column, text_column).alias("draw"),
    )
    skey = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    sized = stored(sized.withColumn("skey", skey), "mix-sizes")
    by_size = stored(sized.groupBy("skey", "source", "size").agg(F.count("*").alias("n")), "mix-counts")
    sources = by_size.groupBy("skey", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(with_targets(sources, weights, most).withColumn("skey", skey).drop("source"), "mix-targets")
    solved = stored(targets.join(multipliers(by_size, targets, most), "skey", "left"), "mix-solved")

    scaled = rate(F.col("multiplier"), F.col("size") / F.col("scale"), most)
    rated = sized.join(solved, "skey").withColumn("rate", F.when(F.col("size") > 0, scaled).otherwise(1.0))
    # The fraction of a rate decides, less its draw: the largest differences are rounded up first.
    whole = F.floor("rate")
    draw = F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53))
    step = F.floor((1 - (F.col("rate") - whole) + draw) / 2 * BINS)
    rated = rated.withColumns({"whole": whole, "step": step, "size_class": size_class(F.col("size"))})
    growing = (F.col("rate") > F.col("whole")) & (F.col("size") > 0)
    steps = rated.where(growing).groupBy("skey", "size_class", "step").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * (F.col("rate") - F.col("whole"))).alias("expected")
    )
    chosen = stored(steps, "mix-steps").groupBy("skey").applyInPandas(thresholds, "skey string, size_class int, chosen long")
    chosen = stored(chosen, "mix-chosen")
    out = rated.join(chosen, ["skey", "size_class"], "left")
    up = growing & (F.col("step") <= F.col("chosen"))
    copies = F.least(F.col("whole") + F.when(up, 1).otherwise(0), F.lit(most)).cast("long")
    return out.select(
        F.col("id").alias(id_column), "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
