"""The contract between a trained model and the matrices it scores.

A blueprint describes the features a model was trained on, one row each; the values of text features are a
table of their own, which may be as long as the data makes it. ``check_contract`` compares a matrix with a blueprint in one
pass over the matrix.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import SYSTEM_COLUMNS
from tidemark.operators.quality import quoted
from tidemark.operators.split import feature_names

# Which actual types a slot takes, by the type it expects. The first line that knows the expected type,
# as its name or among its types, decides.
TYPE_GROUPS = {
    "int64": ["int64", "bigint", "int", "long", "int32", "integer"],
    "int32": ["int32", "integer", "int", "int4", "int64", "bigint"],
    "float64": [
        "float64", "double", "float", "numeric", "float32", "bigint", "integer", "int64", "int32", "int", "long",
    ],
    "float32": [
        "float32", "double", "float", "numeric", "float64", "bigint", "integer", "int64", "int32", "int", "long",
    ],
    "object": ["object", "varchar", "text", "string", "category"],
    "category": ["category", "object", "varchar", "text", "string"],
}

CHECK_COLUMNS = ["feature", "rule", "severity", "passed", "expected", "observed"]


def fits_slot(expected: str, actual: str) -> bool:
    """Whether a column of type ``actual`` may fill a slot of type ``expected``."""
    expected, actual = expected.lower(), actual.lower()
    if expected == actual:
        return True
    group = next((types for name, types in TYPE_GROUPS.items() if expected == name or expected in types), [])
    return actual in group


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _structs(rows: list[list[Column]], names: list[str]) -> Column:
    return F.array(*[F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows])


def _one_row_each(wide: DataFrame, rows: list[list[Column]], names: list[str]) -> DataFrame:
    return wide.select(F.explode(_structs(rows, names)).alias("r")).select("r.*")


def feature_blueprint(features: DataFrame) -> DataFrame:
    """Name, position, type, nullability, kind and domain of each feature, in one pass.

    A number whose values are all 0 or 1 is a ``boolean_indicator``; so is one without any value.
    """
    measured, rows = [], []
    for i, name in enumerate(features.columns):
        value = quoted(name)
        measured.append(F.count_if(value.isNull()).alias(f"nulls{i}"))
        no_number, no_values = F.lit(None).cast("double"), F.lit(None).cast("array<int>")
        if is_text(features, name):
            kind, low, high, allowed = F.lit("categorical"), no_number, no_number, no_values
        else:
            measured += [
                F.min(value).cast("double").alias(f"low{i}"),
                F.max(value).cast("double").alias(f"high{i}"),
                F.count_if(~value.isin(0, 1)).alias(f"other{i}"),
                F.count_if(value == 0).alias(f"zeros{i}"),
                F.count_if(value == 1).alias(f"ones{i}"),
            ]
            flag = F.col(f"other{i}") == 0
            kind = F.when(flag, "boolean_indicator").otherwise("numerical")
            low, high = F.when(~flag, F.col(f"low{i}")), F.when(~flag, F.col(f"high{i}"))
            seen = F.array(F.when(F.col(f"zeros{i}") > 0, 0), F.when(F.col(f"ones{i}") > 0, 1))
            allowed = F.when(flag, F.array_compact(seen))
        stored = F.lit(features.schema[name].dataType.simpleString())
        rows.append([F.lit(name), F.lit(i), stored, F.col(f"nulls{i}") > 0, kind, low, high, allowed])
    names = ["name", "index", "physical_type", "is_nullable", "logical_type", "min", "max", "allowed_values"]
    return _one_row_each(features.agg(*measured), rows, names)


def category_values(features: DataFrame) -> DataFrame:
    """Every value of every text feature, one row each."""
    parts = [
        features.select(F.lit(c).alias("name"), quoted(c).alias("value")).filter("value IS NOT NULL").distinct()
        for c in features.columns
        if is_text(features, c)
    ]
    if not parts:
        return features.sparkSession.createDataFrame([], "name string, value string")
    return reduce(DataFrame.unionByName, parts)


def matrix_schema(matrix: DataFrame) -> DataFrame:
    """Columns of a matrix as entities and features; features are numbered from 0."""
    features = feature_names(matrix)
    rows = [
        (
            f.name,
            f.dataType.simpleString(),
            f.nullable,
            "feature" if f.name in features else "entity",
            features.index(f.name) if f.name in features else None,
        )
        for f in matrix.schema.fields
        if f.name in features or f.name in SYSTEM_COLUMNS
    ]
    schema = "name string, physical_type string, is_nullable boolean, role string, index int"
    return matrix.sparkSession.createDataFrame(rows, schema)


def structure_rules(expected: list[tuple[str, str]], actual: list[tuple[str, str]]) -> list[tuple]:
    """``(feature, rule, passed, expected, observed)`` of presence, position and type.

    ``expected`` and ``actual`` are names and types in order. Further columns after the expected ones are fine.
    """
    types = dict(actual)
    rows = []
    for position, (name, kind) in enumerate(expected):
        rows.append((name, "present", name in types, name, name if name in types else "missing"))
        if name not in types:
            continue
        there = actual[position][0] if position < len(actual) else "None"
        rows.append((name, "position", there == name, name, there))
        rows.append((name, "type", fits_slot(kind, types[name]), kind, types[name]))
    return rows


def blueprint_features(blueprint: DataFrame) -> list[tuple[str, str]]:
    """Names and types in order; one row per feature of the model."""
    rows = blueprint.select("name", "physical_type", "index").collect()
    return [(r["name"], r["physical_type"]) for r in sorted(rows, key=lambda r: r["index"])]


def schema_features(features: DataFrame) -> list[tuple[str, str]]:
    """Names and types in order, from the schema alone."""
    return [(f.name, f.dataType.simpleString()) for f in features.schema.fields if f.name not in SYSTEM_COLUMNS]


def check_contract(expected: list[tuple[str, str]], matrix: DataFrame) -> DataFrame:
    """Population, presence, position and type of all expected features.

    An empty matrix fails for its population and is not looked at further.
    """
    actual = [(c, matrix.schema[c].dataType.simpleString()) for c in feature_names(matrix)]
    population = matrix.agg(F.count(F.lit(1)).alias("n"))
    filled = F.col("n") > 0
    no_name = F.lit(None).cast("string")
    rows = [[no_name, F.lit("population"), F.lit("error"), filled, F.lit("> 0"), F.col("n").cast("string")]]
    for feature, rule, passed, want, have in structure_rules(expected, actual):
        rows.append([F.lit(feature), F.lit(rule), F.lit("error"), F.lit(passed), F.lit(want), F.lit(have)])
    looked_at = F.when(filled, _structs(rows, CHECK_COLUMNS)).otherwise(_structs(rows[:1], CHECK_COLUMNS))
    return population.select(F.explode(looked_at).alias("r")).select("r.*")


def domain_warnings(blueprint: DataFrame, categories: DataFrame, matrix: DataFrame) -> DataFrame:
    """Values outside what the model was trained on. They are warnings: they never close the gate."""
    rules = [r for r in blueprint.collect() if r["name"] in matrix.columns]  # one row per feature
    measured, rows, parts = [], [], []
    for r in rules:
        name, value = r["name"], quoted(r["name"])
        if r["logical_type"] == "categorical":
            known = categories.filter(F.col("name") == name).select("value")
            seen = matrix.select(value.alias("value")).filter("value IS NOT NULL").distinct()
            unknown = seen.join(known, "value", "left_anti").agg(F.count(F.lit(1)).alias("n"))
            parts.append((unknown, name, "known values", F.col("n")))
            continue
        if r["logical_type"] == "boolean_indicator":
            outside, want = ~value.isin(r["allowed_values"] or [None]), str(r["allowed_values"])
        else:
            outside, want = (value < r["min"]) | (value > r["max"]), f"{r['min']} to {r['max']}"
        column = f"w{len(measured)}"
        measured.append(F.count_if(outside).alias(column))
        rows.append([F.lit(name), F.lit("domain"), F.lit("warn"), F.col(column) == 0, F.lit(want),
                     F.col(column).cast("string")])
    results = [_one_row_each(matrix.agg(*measured), rows, CHECK_COLUMNS)] if rows else []
    for unknown, name, want, n in parts:
        row = [F.lit(name), F.lit("domain"), F.lit("warn"), n == 0, F.lit(want), n.cast("string")]
        results.append(unknown.select(*[c.alias(k) for c, k in zip(row, CHECK_COLUMNS)]))
    return reduce(DataFrame.unionByName, results)


def extra_feature_warnings(expected: list[tuple[str, str]], matrix: DataFrame) -> DataFrame:
    """A warning for each feature of the matrix that the model does not know."""
    known = {name for name, _ in expected}
    rows = [(c, "extra", "warn", False, "not a feature of the model", c) for c in feature_names(matrix) if c not in known]
    kinds = "feature string, rule string, severity string, passed boolean, expected string, observed string"
    return matrix.sparkSession.createDataFrame(rows, kinds)


def read_contract(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The stored blueprint and categories of a model."""
    schema = (
        "name string, index int, physical_type string, is_nullable boolean, logical_type string, min double, max double, "
        "allowed_values array<double>"
    )
    return spark.read.schema(schema).json(f"{folder}/features"), spark.read.parquet(f"{folder}/categories")


def contract_result(checks: DataFrame) -> DataFrame:
    """Validity and number of errors."""
    errors = F.count_if((F.col("severity") == "error") & ~F.col("passed"))
    return checks.agg((errors == 0).alias("is_valid"), errors.alias("errors"))
