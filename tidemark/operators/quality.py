"""Quality job: declared rules against raw tables.

Each table costs one aggregate pass for counts, missing values and allowed values, plus one grouped pass over a single
column for each unique column. Every rule gives a row ``(table_name, column_name, rule, passed, observed, expected)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK_SCHEMA = (
    "table_name string, column_name string, rule string, passed boolean, observed string, expected string"
)

# Names that rule files use for column types.
TYPE_NAMES = {
    T.StringType: "VARCHAR",
    T.BooleanType: "BOOLEAN",
    T.ByteType: "TINYINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.FloatType: "FLOAT",
    T.DoubleType: "DOUBLE",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    T.BinaryType: "BLOB",
}


def type_name(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return TYPE_NAMES.get(type(kind), kind.simpleString().upper())


def declared_schema(rules: dict) -> T.StructType:
    """Read schema of a table from its rules, so that a CSV gets the declared types."""
    kinds = {name: kind for kind, name in TYPE_NAMES.items()}
    return T.StructType([T.StructField(c, kinds[r["dtype"]]()) for c, r in rules["columns"].items()])


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _rows(wide: DataFrame, rows: list[list[Column]], names: list[str]) -> DataFrame:
    """One output row per entry of ``rows``, from a table of one row."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def profile(df: DataFrame, table_name: str) -> DataFrame:
    """Position, type, rows and missing values of each column, in one pass."""
    names = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(quoted(c).isNull()).alias(f"m{i}") for i, c in enumerate(names)]
    )
    rows = [
        [F.lit(table_name), F.lit(c), F.lit(i), F.lit(type_name(df.schema[c].dataType)), F.col("n"), F.col(f"m{i}")]
        for i, c in enumerate(names)
    ]
    return _rows(wide, rows, ["table_name", "column_name", "position", "data_type", "num_rows", "missing_values"])


def profiles(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(df, name) for name, df in tables.items()])


def total_rows(profile_rows: DataFrame) -> DataFrame:
    """Number of tables and of rows over all of them, from their profiles."""
    per_table = profile_rows.groupBy("table_name").agg(F.max("num_rows").alias("n"))
    return per_table.agg(F.count(F.lit(1)).alias("num_tables"), F.sum("n").alias("total_rows"))


def not_allowed(df: DataFrame, name: str, allowed: list) -> Column:
    """True where a value is present and not in the list. A listed number never equals a text, nor a text a number."""
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    comparable = [v for v in allowed if isinstance(v, str) == is_text]
    value = quoted(name)
    return value.isNotNull() & ~value.isin(comparable) if comparable else value.isNotNull()


def missing_share(missing: Column, rows: Column) -> Column:
    return missing / F.greatest(rows, F.lit(1))


def duplicated_keys(df: DataFrame, name: str) -> DataFrame:
    """Values that occur more than once, NULL included. Rows are counted before they are shuffled."""
    return df.groupBy(quoted(name).alias("value")).count().filter(F.col("count") > 1)


def _fixed(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def _schema_checks(spark: SparkSession, df: DataFrame, name: str, rules: dict) -> list[tuple]:
    """Rules that need only the schema."""
    rows = [(name, None, "table_present", True, "present", "present")]
    if "num_columns" in rules:
        have, want = len(df.columns), rules["num_columns"]
        rows.append((name, None, "column_count", have == want, str(have), str(want)))
    for column, rule in rules["columns"].items():
        present = column in df.columns
        rows.append((name, column, "column_present", present, "present" if present else "missing", "present"))
        if present and rule.get("dtype"):
            have = type_name(df.schema[column].dataType)
            rows.append((name, column, "data_type", have == rule["dtype"], have, rule["dtype"]))
    return rows


def _value_checks(df: DataFrame, name: str, rules: dict) -> DataFrame | None:
    """Missing share and allowed values of all columns in one pass."""
    columns = {c: r for c, r in rules["columns"].items() if c in df.columns}
    if not columns:
        return None
    measured = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, (c, rule) in enumerate(columns.items()):
        measured.append(F.count_if(quoted(c).isNull()).alias(f"m{i}"))
        limit = float(rule.get("max_missing_percentage", 0.0))
        share = missing_share(F.col(f"m{i}"), F.col("n"))
        rows.append([c, "missing_share", share <= limit, share.cast("string"), F.lit(str(limit))])
        if "allowed_values" in rule:
            allowed = rule["allowed_values"]
            measured.append(F.count_if(not_allowed(df, c, allowed)).alias(f"a{i}"))
            bad = F.col(f"a{i}")
            rows.append([c, "allowed_values", bad == 0, bad.cast("string"), F.lit(str(allowed))])
    cells = [[F.lit(name), F.lit(c), F.lit(rule), ok, seen, want] for c, rule, ok, seen, want in rows]
    return _rows(df.agg(*measured), cells, ["table_name", "column_name", "rule", "passed", "observed", "expected"])


def _unique_check(df: DataFrame, name: str, column: str) -> DataFrame:
    repeated = duplicated_keys(df, column).agg(F.count(F.lit(1)).alias("n"))
    return repeated.select(
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit("unique").alias("rule"),
        (F.col("n") == 0).alias("passed"),
        F.col("n").cast("string").alias("observed"),
        F.lit("0").alias("expected"),
    )


def check_table(spark: SparkSession, df: DataFrame | None, name: str, rules: dict, missing_ok: bool = False) -> DataFrame:
    """All rules of one table. Only an allowed missing table passes without its data."""
    if df is None:
        return _fixed(spark, [(name, None, "table_present", missing_ok, "missing", "present")])
    parts = [_fixed(spark, _schema_checks(spark, df, name, rules))]
    values = _value_checks(df, name, rules)
    parts += [values] if values is not None else []
    parts += [
        _unique_check(df, name, c) for c, r in rules["columns"].items() if r.get("unique") and c in df.columns
    ]
    return reduce(DataFrame.unionByName, parts)


def check_tables(spark: SparkSession, tables: dict[str, DataFrame], rule_file: dict) -> DataFrame:
    """All rules of all declared tables. Tables without rules are not checked."""
    missing_ok = rule_file.get("validation_rules", {}).get("allow_missing_tables", False)
    parts = [
        check_table(spark, tables.get(name), name, rules, missing_ok) for name, rules in rule_file["tables"].items()
    ]
    return reduce(DataFrame.unionByName, parts)


def table_results(checks: DataFrame) -> DataFrame:
    """A table is valid when all its rules passed."""
    return checks.groupBy("table_name").agg(
        F.every("passed").alias("is_valid"), F.count_if(~F.col("passed")).alias("failed_checks")
    )


def overall_result(checks: DataFrame) -> DataFrame:
    """Tables, passed tables, failed tables, and whether all passed."""
    return table_results(checks).agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if("is_valid").alias("passed_tables"),
        F.count_if(~F.col("is_valid")).alias("failed_tables"),
        F.every("is_valid").alias("is_valid"),
    )


def gate_is_open(checks: DataFrame) -> bool:
    return bool(overall_result(checks).first()["is_valid"])


def proven_unique(checks: DataFrame) -> set[tuple[str, str]]:
    """Table and column of every unique rule that passed; one row per declared rule."""
    rows = checks.filter("rule = 'unique' AND passed").select("table_name", "column_name").collect()
    return {(r.table_name, r.column_name) for r in rows}
