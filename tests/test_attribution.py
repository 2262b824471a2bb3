from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.operators import attribution

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.range(600).select(
        F.col("id"), (F.col("id") % 7).cast("double").alias("a__value"), (F.col("id") % 11).cast("double").alias("b__value"),
        (F.col("id") % 3).cast("double").alias("c__value"), F.lit(1.0).alias("w"),
    )
    rows = rows.withColumn("label", ((F.col("a__value") > 3).cast("int") + (F.col("b__value") * F.col("c__value") > 6).cast("int") > 0).cast("double"))
    assembler = VectorAssembler(inputCols=[n + "__value" for n in NAMES], outputCol="features")
    trees = GBTClassifier(maxIter=4, maxDepth=4, seed=3).fit(assembler.transform(rows))
    return PipelineModel([assembler, trees]), rows


def expected(node, row, known):
    """Mean of a tree for a row of which only the ``known`` inputs are given."""
    if node.numDescendants() == 0:
        return node.prediction()
    k, threshold = node.split().featureIndex(), node.split().threshold()
    left, right = node.leftChild(), node.rightChild()
    if k in known:
        return expected(left if row[k] <= threshold else right, row, known)
    n = [side.impurityStats().count() for side in (left, right)]
    return sum(c * expected(side, row, known) for c, side in zip(n, (left, right), strict=True)) / sum(n)


def test_equals_enumeration_of_coalitions(fitted, spark):
    model, rows = fitted
    trees = model.stages[-1]
    roots = [t._call_java("rootNode") if hasattr(t, "_call_java") else t.rootNode for t in trees.trees]
    got = attribution.attributions(model, rows.limit(12), NAMES, ["id"]).collect()
    inputs = {r.id: (r.a__value, r.b__value, r.c__value) for r in rows.limit(12).collect()}

    def value(row, known):
        return sum(w * expected(r, row, known) for w, r in zip(trees.treeWeights, roots, strict=True))

    for r in got:
        row = inputs[r.id]
        assert r.base_value == pytest.approx(value(row, ()))
        for i, name in enumerate(NAMES):
            others = [k for k in range(3) if k != i]
            total = 0.0
            for size in range(3):
                for known in combinations(others, size):
                    weight = factorial(size) * factorial(2 - size) / factorial(3)
                    total += weight * (value(row, (*known, i)) - value(row, known))
            assert r[name] == pytest.approx(total, abs=1e-10)


def test_adds_up_for_all_rows(fitted):
    model, rows = fitted
    out = attribution.attributions(model, rows.repartition(5), NAMES, ["id"])
    assert out.count() == rows.count()
    assert out.where("abs(base_value + a + b + c - raw_score) > 1e-9").isEmpty()
    means = {r.feature: r.mean_attribution for r in attribution.mean_attributions(out, NAMES).collect()}
    assert means["a"] > 0 and set(means) == set(NAMES)
    assert attribution.attributions(model, rows.limit(0), NAMES, ["id"]).count() == 0


def test_no_exchange_and_bound(fitted, monkeypatch, spark):
    model, rows = fitted
    plan = attribution.attributions(model, rows, NAMES, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    monkeypatch.setattr(attribution, "MOST_NODES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        attribution.leaves(spark, model.stages[-1])


def test_pattern_table_of_one_input():
    leaf = attribution.Leaf((2,), (0.0,), (1.0,), (0.25,), 8.0)
    assert np.allclose(attribution.pattern_table(leaf), [[-2.0], [6.0]])
