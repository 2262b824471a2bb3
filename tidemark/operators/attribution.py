"""Shapley attributions of boosted trees, per row and per feature.

An ensemble is taken apart into its leaves. A leaf holds the interval of each input that its path tests, the share of the
training weight that these tests let through, and its value. For one leaf and one row each input on the path either holds or
fails, so a row falls into one of ``2 ** inputs`` patterns, and the attribution of each input depends on the pattern only. These
small tables are made once per task; each row looks its patterns up and adds them over the leaves. An input that is left out
of a coalition follows both sides of its tests in the shares of the training weight.

The attributions of a row add up to its raw score less the base value, which is the mean raw score of the training weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import scratch_path

#: Nodes of an ensemble that go to the driver and the tasks; larger ones are refused.
MOST_NODES = 1 << 20
VECTOR = "__attributed"


class Leaf(NamedTuple):
    inputs: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    share: tuple[float, ...]
    value: float


def trees_of(model: PipelineModel):
    return next(s for s in model.stages if hasattr(s, "featureImportances"))


def leaves(spark: SparkSession, trees) -> list[Leaf]:
    """The leaves of a fitted ensemble, read from its stored form. A path holds where ``low < input <= high`` for its inputs."""
    path = scratch_path(spark, "trees")
    trees.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    if nodes.count() > MOST_NODES:
        raise ValueError(f"the ensemble has more than {MOST_NODES} nodes")
    node = {(n.treeID, n.id): n for n in nodes.collect()}
    weights = trees.treeWeights
    found = []
    for tree, weight in enumerate(weights):
        work = [(0, {})]
        while work:
            i, tests = work.pop()
            n = node[tree, i]
            if n.leftChild < 0:
                inputs = tuple(sorted(tests))
                found.append(Leaf(inputs, *zip(*(tests[k] for k in inputs), strict=True), weight * n.prediction) if inputs else Leaf((), (), (), (), weight * n.prediction))
                continue
            if n.split.numCategories >= 0:
                raise ValueError("only tests of numbers are known")
            k, (threshold,) = n.split.featureIndex, n.split.leftCategoriesOrThreshold
            low, high, share = tests.get(k, (-math.inf, math.inf, 1.0))
            for child, bounds in ((n.leftChild, (low, min(high, threshold))), (n.rightChild, (max(low, threshold), high))):
                passed = node[tree, child].impurityStats[0] / n.impurityStats[0]
                work.append((child, tests | {k: (*bounds, share * passed)}))
    return found


def pattern_table(leaf: Leaf) -> np.ndarray:
    """Attributions by pattern: row p has those of the leaf's inputs where input j holds if bit j of p is set."""
    n = len(leaf.inputs)
    holds = (np.arange(1 << n)[:, None] >> np.arange(n) & 1).astype(float)
    table = np.empty((1 << n, n))
    # Weight of the coalitions of k other inputs.
    weight = [math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) for k in range(n)]
    for i in range(n):
        sums = [np.ones(1 << n)]  # sums[k]: over all coalitions of k of the inputs seen, what the leaf keeps of its value
        for j in range(n):
            if j != i:
                grown = [s * leaf.share[j] for s in sums] + [np.zeros(1 << n)]
                for k, s in enumerate(sums):
                    grown[k + 1] = grown[k + 1] + s * holds[:, j]
                sums = grown
        kept = sum(w * s for w, s in zip(weight, sums, strict=True))
        table[:, i] = leaf.value * (holds[:, i] - leaf.share[i]) * kept
    return table


def attributed(matrix: np.ndarray, parts: list[tuple[Leaf, np.ndarray]]) -> np.ndarray:
    """Attributions (rows x inputs) of a matrix of input values."""
    out = np.zeros(matrix.shape)
    for leaf, table in parts:
        pattern = np.zeros(len(matrix), np.int64)
        for j, (k, low, high) in enumerate(zip(leaf.inputs, leaf.low, leaf.high, strict=True)):
            pattern |= ((matrix[:, k] > low) & (matrix[:, k] <= high)).astype(np.int64) << j
        for j, k in enumerate(leaf.inputs):
            out[:, k] += table[pattern, j]
    return out


def attributions(model: PipelineModel, rows: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``keys`` of each row, base_value, raw_score and the attribution of each feature, for all rows.

    A feature's attribution is that of its inputs together: its value or rate and its missing flag. Only the ensemble goes to the
    tasks; rows stay where they are, without an exchange. No rows give no rows.
    """
    spark = rows.sparkSession
    trees = trees_of(model)
    found = leaves(spark, trees)
    base = sum(leaf.value * math.prod(leaf.share) for leaf in found)
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    owner = [list(features).index(n.rsplit("__", 1)[0]) for n in names]
    raw = trees.getRawPredictionCol()
    # A fitted pipeline may have calibration behind its trees; the raw score is that of these trees.
    scored = model.transform(rows).select(*keys, vector_to_array(trees.getFeaturesCol()).alias(VECTOR), vector_to_array(raw)[1].alias("raw_score"))
    schema = T.StructType(
        [*scored.select(*keys).schema.fields, T.StructField("base_value", T.DoubleType()), T.StructField("raw_score", T.DoubleType())]
        + [T.StructField(f, T.DoubleType()) for f in features]
    )
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(leaf, pattern_table(leaf)) for leaf in found if leaf.inputs]
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = batch.column(VECTOR).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(names))
            each = attributed(matrix, parts)
            columns = [batch.column(k) for k in keys] + [pa.array(np.full(batch.num_rows, base)), batch.column("raw_score")]
            columns += [pa.array(each[:, [i for i, o in enumerate(owner) if o == f]].sum(axis=1)) for f in range(len(features))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return scored.mapInArrow(task, schema)


def mean_attributions(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean_attribution): mean absolute attribution per feature, gathered in one aggregate of one row."""
    means = rows.agg(*[F.avg(F.abs(f)).alias(f) for f in features])
    return means.unpivot([], list(features), "feature", "mean_attribution")
