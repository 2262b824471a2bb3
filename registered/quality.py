"""Rules on raw tables, splits, blueprint and contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered import sql
from registered.features import matrix
from registered.registry import query
from registered.sql import with_base
from registered.storage import split_panel
from tidemark.columns import LABEL
from tidemark.operators import contract, quality, split
from tidemark.sources import sample_data as data

# Rules for the given tables. Two of them fail: line items are not unique per order, and no document has so few
# characters.
RULES = {
    "validation_rules": {"allow_missing_tables": False},
    "tables": {
        "orders": {
            "num_columns": 6,
            "columns": {
                "o_orderkey": {"dtype": "BIGINT", "unique": True},
                "o_custkey": {"dtype": "BIGINT"},
                "o_orderstatus": {"dtype": "VARCHAR", "allowed_values": ["F", "O", "P"]},
                "o_orderdate": {"dtype": "TIMESTAMP"},
            },
        },
        "customer": {
            "num_columns": 5,
            "columns": {
                "c_custkey": {"dtype": "BIGINT", "unique": True},
                "c_nationkey": {"dtype": "INTEGER", "allowed_values": list(range(25))},
                "c_acctbal": {"dtype": "DOUBLE", "max_missing_percentage": 0.1},
            },
        },
        "lineitem": {
            "num_columns": 11,
            "columns": {
                "l_orderkey": {"dtype": "BIGINT", "unique": True},
                "l_returnflag": {"dtype": "VARCHAR", "allowed_values": ["A", "N", "R"]},
                "l_shipmode": {"dtype": "VARCHAR"},
            },
        },
        "labels": {
            "columns": {
                "doc_id": {"dtype": "BIGINT", "unique": True},
                "quality": {"dtype": "INTEGER", "allowed_values": [0]},
                "toxic": {"dtype": "DOUBLE"},
            }
        },
    },
}
PROFILED = ("orders", "customer", "lineitem", "labels", "documents")


def tables(spark, folder, names=("orders", "customer", "lineitem", "labels")):
    return {name: data.table(spark, folder, name) for name in names}


def _missing(table: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS num_rows, COUNT(*) - COUNT({c}) "
        f"AS missing_values FROM {table}"
        for c in columns.split()
    )


COLUMNS = {
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "labels": "doc_id quality toxic",
    "documents": "doc_id text lang source n_chars",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate",
}


@query("a8_column_profile", " UNION ALL ".join(_missing(t, COLUMNS[t]) for t in PROFILED))
def column_profile(spark, folder):
    rows = quality.profiles(tables(spark, folder, PROFILED))
    return rows.select("table_name", "column_name", "num_rows", "missing_values")


@query(
    "a9_total_rows",
    "SELECT CAST(5 AS BIGINT) AS num_tables, (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM customer) + "
    "(SELECT COUNT(*) FROM lineitem) + (SELECT COUNT(*) FROM labels) + (SELECT COUNT(*) FROM documents) "
    "AS total_rows",
)
def total_rows(spark, folder):
    return quality.total_rows(quality.profiles(tables(spark, folder, PROFILED)))


KINDS = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "VARCHAR", "o_totalprice": "DOUBLE",
         "o_orderdate": "TIMESTAMP", "o_orderpriority": "VARCHAR"}


@query(
    "d1_table_profile",
    " UNION ALL ".join(
        f"SELECT 'orders' AS table_name, '{c}' AS column_name, {i} AS position, typeof(ANY_VALUE({c})) AS data_type, "
        f"COUNT(*) AS num_rows, COUNT(*) - COUNT({c}) AS missing_values FROM orders"
        for i, c in enumerate(KINDS)
    ),
)
def table_profile(spark, folder):
    return quality.profile(data.table(spark, folder, "orders"), "orders")


@query(
    "a10_duplicated_keys",
    "SELECT l_orderkey AS value, COUNT(*) AS count FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1",
)
def duplicated_keys(spark, folder):
    return quality.duplicated_keys(data.table(spark, folder, "lineitem"), "l_orderkey")


@query(
    "p9_values_outside_list",
    "SELECT COUNT(*) FILTER (WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) "
    "AS outside FROM orders",
)
def values_outside_list(spark, folder):
    orders = data.table(spark, folder, "orders")
    outside = quality.not_allowed(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return orders.agg(F.count_if(outside).alias("outside"))


def checks(spark, folder):
    return quality.check_tables(spark, tables(spark, folder), RULES)


def _unique_sql(table, column):
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'unique' AS rule, "
            f"COUNT(*) = COUNT(DISTINCT {column}) AS passed FROM {table}")


def _allowed_sql(table, column, values):
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'allowed_values' AS rule, "
            f"COUNT(*) FILTER (WHERE {column} NOT IN ({values})) = 0 AS passed FROM {table}")


def _share_sql(table, column, limit=0.0):
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'missing_share' AS rule, "
            f"(COUNT(*) - COUNT({column})) / GREATEST(COUNT(*), 1) <= {limit} AS passed FROM {table}")


NATIONS = ", ".join(str(i) for i in range(25))
UNIQUE_SQL = " UNION ALL ".join(
    [_unique_sql("orders", "o_orderkey"), _unique_sql("customer", "c_custkey"), _unique_sql("lineitem", "l_orderkey"),
     _unique_sql("labels", "doc_id")]
)
ALLOWED_SQL = " UNION ALL ".join(
    [_allowed_sql("orders", "o_orderstatus", "'F', 'O', 'P'"), _allowed_sql("customer", "c_nationkey", NATIONS),
     _allowed_sql("lineitem", "l_returnflag", "'A', 'N', 'R'"), _allowed_sql("labels", "quality", "0")]
)
SHARE_SQL = " UNION ALL ".join(
    [_share_sql("orders", c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")]
    + [_share_sql("customer", "c_custkey"), _share_sql("customer", "c_nationkey"),
       _share_sql("customer", "c_acctbal", 0.1)]
    + [_share_sql("lineitem", "l_orderkey"), _share_sql("lineitem", "l_returnflag")]
    + [_share_sql("labels", c) for c in ("doc_id", "quality", "toxic")]
)
# Rules that follow from the schema alone.
SCHEMA_SQL = """SELECT * FROM (VALUES
  ('orders', NULL, 'table_present', TRUE), ('orders', NULL, 'column_count', TRUE),
  ('orders', 'o_orderkey', 'column_present', TRUE), ('orders', 'o_orderkey', 'data_type', TRUE),
  ('orders', 'o_custkey', 'column_present', TRUE), ('orders', 'o_custkey', 'data_type', TRUE),
  ('orders', 'o_orderstatus', 'column_present', TRUE), ('orders', 'o_orderstatus', 'data_type', TRUE),
  ('orders', 'o_orderdate', 'column_present', TRUE), ('orders', 'o_orderdate', 'data_type', TRUE),
  ('customer', NULL, 'table_present', TRUE), ('customer', NULL, 'column_count', TRUE),
  ('customer', 'c_custkey', 'column_present', TRUE), ('customer', 'c_custkey', 'data_type', TRUE),
  ('customer', 'c_nationkey', 'column_present', TRUE), ('customer', 'c_nationkey', 'data_type', TRUE),
  ('customer', 'c_acctbal', 'column_present', TRUE), ('customer', 'c_acctbal', 'data_type', TRUE),
  ('lineitem', NULL, 'table_present', TRUE), ('lineitem', NULL, 'column_count', TRUE),
  ('lineitem', 'l_orderkey', 'column_present', TRUE), ('lineitem', 'l_orderkey', 'data_type', TRUE),
  ('lineitem', 'l_returnflag', 'column_present', TRUE), ('lineitem', 'l_returnflag', 'data_type', TRUE),
  ('lineitem', 'l_shipmode', 'column_present', FALSE),
  ('labels', NULL, 'table_present', TRUE),
  ('labels', 'doc_id', 'column_present', TRUE), ('labels', 'doc_id', 'data_type', TRUE),
  ('labels', 'quality', 'column_present', TRUE), ('labels', 'quality', 'data_type', TRUE),
  ('labels', 'toxic', 'column_present', TRUE), ('labels', 'toxic', 'data_type', FALSE)
) AS t(table_name, column_name, rule, passed)"""
ALL_SQL = " UNION ALL ".join(
    f"SELECT table_name, column_name, rule, passed FROM ({q})" for q in (SCHEMA_SQL, SHARE_SQL, ALLOWED_SQL, UNIQUE_SQL)
)
RESULT = ["table_name", "column_name", "rule", "passed"]


def _rules(spark, folder, *names):
    return checks(spark, folder).filter(F.col("rule").isin(*names)).select(*RESULT)


@query("d2_quality_report", ALL_SQL)
def quality_report(spark, folder):
    """All rules of all tables: presence, column count, types, missing share, allowed values, uniqueness."""
    return checks(spark, folder).select(*RESULT)


def _only(*rules: str) -> str:
    return f"SELECT * FROM ({ALL_SQL}) WHERE rule IN ({', '.join(repr(r) for r in rules)})"


# Rules on the schema are reported with the rules on the data they stand beside.


@query("d3_column_count", _only("table_present", "column_count", "unique"))
def column_count(spark, folder):
    return _rules(spark, folder, "table_present", "column_count", "unique")


@query("d4_column_presence", _only("column_present", "missing_share"))
def column_presence(spark, folder):
    return _rules(spark, folder, "column_present", "missing_share")


@query("d5_data_types", _only("data_type", "allowed_values"))
def data_types(spark, folder):
    return _rules(spark, folder, "data_type", "allowed_values")


@query("d6_missing_share", SHARE_SQL)
def missing_share(spark, folder):
    return _rules(spark, folder, "missing_share")


@query("d7_allowed_values", ALLOWED_SQL)
def allowed_values(spark, folder):
    return _rules(spark, folder, "allowed_values")


@query("d8_unique_columns", UNIQUE_SQL)
def unique_columns(spark, folder):
    return _rules(spark, folder, "unique")


TABLE_SQL = (f"SELECT table_name, BOOL_AND(passed) AS is_valid, COUNT(*) FILTER (WHERE NOT passed) AS failed_checks "
             f"FROM ({ALL_SQL}) GROUP BY table_name")


@query("d9_table_results", TABLE_SQL)
def table_results(spark, folder):
    return quality.table_results(checks(spark, folder))


@query(
    "d10_gate",
    f"SELECT COUNT(*) AS total_tables, COUNT(*) FILTER (WHERE is_valid) AS passed_tables, "
    f"COUNT(*) FILTER (WHERE NOT is_valid) AS failed_tables, BOOL_AND(is_valid) AS is_valid FROM ({TABLE_SQL})",
)
def gate(spark, folder):
    return quality.overall_result(checks(spark, folder))


# --- splits


@query("m1_out_of_time_split", with_base("SELECT customer_unique_id, snapshot_date, split FROM split", sql.PANEL, sql.SPLIT))
def out_of_time_split(spark, folder):
    return split_panel(spark, folder).select("customer_unique_id", "snapshot_date", "split")


@query(
    "m2_train_features_and_label",
    with_base(
        "SELECT * EXCLUDE (customer_unique_id, snapshot_date, target_180d_ltv, split) FROM split WHERE split = 'train'",
        sql.PANEL,
        sql.SPLIT,
    ),
)
def train_features_and_label(spark, folder):
    train = split.one_split(split_panel(spark, folder), "train")
    return train.select(*split.feature_names(train), LABEL)


@query(
    "a20_split_counts",
    with_base(
        "SELECT COUNT(*) FILTER (WHERE split = 'train') AS train_rows, COUNT(*) FILTER (WHERE split = 'val') AS "
        "val_rows, COUNT(*) FILTER (WHERE split = 'test') AS test_rows, COUNT(*) AS total_rows FROM split",
        sql.PANEL,
        sql.SPLIT,
    ),
)
def split_counts(spark, folder):
    return split.split_counts(split_panel(spark, folder))


BALANCE_SQL = with_base(
    "SELECT COUNT(*) AS train_rows, CAST(SUM(target_is_churn) AS BIGINT) AS positives, "
    "COALESCE(ROUND((COUNT(*) - SUM(target_is_churn)) / NULLIF(SUM(target_is_churn), 0), 4), 1.0) AS imbalance_ratio, "
    "(COUNT(*) - SUM(target_is_churn)) / GREATEST(SUM(target_is_churn), 1) AS positive_weight "
    "FROM split WHERE split = 'train'",
    sql.PANEL,
    sql.SPLIT,
)


@query("a11_class_balance", BALANCE_SQL)
def class_balance(spark, folder):
    return split.class_balance(split.one_split(split_panel(spark, folder), "train"))


@query("a12_positive_weight", BALANCE_SQL)
def positive_weight(spark, folder):
    return split.class_balance(split.one_split(split_panel(spark, folder), "train"))


# --- blueprint and contract

FEATURES = [
    ("customer_state", "string"), ("recency_days", "bigint"), ("tenure_days", "bigint"), ("frequency", "bigint"),
    ("monetary_total", "double"), ("aov", "double"), ("max_delivery_delay_days", "bigint"),
    ("has_undelivered_order", "int"), ("total_canceled_orders", "bigint"),
]


def _blueprint_sql(i, name, kind):
    if kind == "string":
        return (f"SELECT '{name}' AS name, {i} AS index, '{kind}' AS physical_type, COUNT({name}) < COUNT(*) AS "
                f"is_nullable, 'categorical' AS logical_type, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, "
                f"CAST(NULL AS VARCHAR) AS allowed FROM train")
    flag = f"COUNT(*) FILTER (WHERE {name} NOT IN (0, 1)) = 0"
    return (f"SELECT '{name}', {i}, '{kind}', COUNT({name}) < COUNT(*), "
            f"CASE WHEN {flag} THEN 'boolean_indicator' ELSE 'numerical' END, "
            f"CASE WHEN NOT {flag} THEN CAST(MIN({name}) AS DOUBLE) END, "
            f"CASE WHEN NOT {flag} THEN CAST(MAX({name}) AS DOUBLE) END, "
            f"CASE WHEN {flag} THEN STRING_AGG(DISTINCT CAST({name} AS VARCHAR), ',' ORDER BY CAST({name} AS VARCHAR)) "
            f"END FROM train")


TRAIN = "train AS (SELECT * FROM split WHERE split = 'train')"
BLUEPRINT_SQL = with_base(
    " UNION ALL ".join(_blueprint_sql(i, n, k) for i, (n, k) in enumerate(FEATURES)), sql.PANEL, sql.SPLIT, TRAIN
)


def train_features(spark, folder):
    return split.features_of(split.one_split(split_panel(spark, folder), "train"))


@query("a14_feature_domains", BLUEPRINT_SQL)
def feature_domains(spark, folder):
    rows = contract.feature_blueprint(train_features(spark, folder))
    allowed = F.when(F.col("allowed_values").isNotNull(), F.concat_ws(",", F.col("allowed_values").cast("array<string>")))
    return rows.withColumn("allowed", allowed).drop("allowed_values")


@query("d14_feature_blueprint", BLUEPRINT_SQL)
def feature_blueprint(spark, folder):
    return feature_domains(spark, folder)


@query(
    "o2_allowed_values",
    with_base("SELECT DISTINCT 'customer_state' AS name, customer_state AS value FROM train ORDER BY 2", sql.PANEL,
              sql.SPLIT, TRAIN),
)
def allowed_value_list(spark, folder):
    return contract.category_values(train_features(spark, folder)).orderBy("name", "value")


@query(
    "d15_matrix_schema",
    with_base(
        "SELECT 'entity' AS role, name, CAST(NULL AS INTEGER) AS index, n AS num_rows FROM "
        "(VALUES ('customer_unique_id'), ('snapshot_date')) e(name), (SELECT COUNT(*) AS n FROM matrix) UNION ALL "
        "SELECT 'feature', name, index, n FROM (VALUES "
        + ", ".join(f"('{n}', {i})" for i, (n, _) in enumerate(FEATURES))
        + ") f(name, index), (SELECT COUNT(*) AS n FROM matrix)",
        sql.MATRIX,
    ),
)
def matrix_schema(spark, folder):
    """Entities and features of the matrix with its number of rows."""
    rows = matrix(spark, folder)
    described = contract.matrix_schema(rows).collect()  # one row per column
    counted = rows.agg(F.count(F.lit(1)).alias("num_rows"))
    entries = [
        F.struct(
            F.lit(r["role"]).alias("role"), F.lit(r["name"]).alias("name"), F.lit(r["index"]).cast("int").alias("index")
        )
        for r in described
    ]
    return counted.select("num_rows", F.explode(F.array(*entries)).alias("e")).select("num_rows", "e.*")


def _contract_rows_sql():
    rows = ["SELECT CAST(NULL AS VARCHAR) AS feature, 'population' AS rule, COUNT(*) > 0 AS passed, "
            "CAST(COUNT(*) AS VARCHAR) AS observed FROM matrix"]
    for name, kind in FEATURES:
        rows += [f"SELECT '{name}', '{rule}', TRUE, '{seen}'"
                 for rule, seen in (("present", name), ("position", name), ("type", kind))]
    return " UNION ALL ".join(rows)


@query("d16_contract_check", with_base(_contract_rows_sql(), sql.MATRIX))
def contract_check(spark, folder):
    """The matrix of the last snapshot against the features of the training split."""
    expected = contract.schema_features(train_features(spark, folder))
    rows = contract.check_contract(expected, matrix(spark, folder))
    return rows.select("feature", "rule", "passed", "observed")


@query(
    "d17_contract_violations",
    with_base(
        "SELECT feature, rule, expected, observed FROM (VALUES "
        "('recency_days', 'position', 'recency_days', 'tenure_days'), "
        "('tenure_days', 'position', 'tenure_days', 'recency_days'), ('frequency', 'type', 'bigint', 'double'), "
        "('aov', 'present', 'aov', 'missing'), "
        "('max_delivery_delay_days', 'position', 'max_delivery_delay_days', 'total_canceled_orders'), "
        "('has_undelivered_order', 'position', 'has_undelivered_order', 'max_delivery_delay_days'), "
        "('total_canceled_orders', 'position', 'total_canceled_orders', 'None')"
        ") t(feature, rule, expected, observed), (SELECT COUNT(*) AS n FROM matrix) WHERE n > 0",
        sql.MATRIX,
    ),
)
def contract_violations(spark, folder):
    """A matrix with swapped, missing and wrongly typed features against the features it should have."""
    good = matrix(spark, folder)
    expected = [(n, good.schema[n].dataType.simpleString()) for n in split.feature_names(good)]
    bad = good.select(
        "customer_unique_id", "customer_state", "tenure_days", "recency_days", F.col("frequency").cast("double").alias(
            "frequency"), "monetary_total", "has_undelivered_order", "total_canceled_orders", "max_delivery_delay_days",
    )
    wrong = contract.check_contract(expected, bad).filter(~F.col("passed"))
    return wrong.select("feature", "rule", "expected", "observed")


@query(
    "d18_type_slots",
    with_base("SELECT TRUE AS bigint_in_float_slot, FALSE AS double_in_int_slot, COUNT(*) AS num_rows FROM matrix",
              sql.MATRIX),
)
def type_slots(spark, folder):
    """What the slots of the matrix's own columns take."""
    rows = matrix(spark, folder)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.agg(
        F.lit(contract.fits_slot(kind["aov"], kind["frequency"])).alias("bigint_in_float_slot"),
        F.lit(contract.fits_slot(kind["frequency"], kind["aov"])).alias("double_in_int_slot"),
        F.count(F.lit(1)).alias("num_rows"),
    )


@query(
    "d20_contract_result",
    with_base("SELECT COUNT(*) > 0 AS is_valid, CAST(0 AS BIGINT) AS errors FROM matrix", sql.MATRIX),
)
def contract_result(spark, folder):
    expected = contract.schema_features(train_features(spark, folder))
    return contract.contract_result(contract.check_contract(expected, matrix(spark, folder)))


def _domain_sql():
    rows = ["SELECT 'customer_state' AS feature, COUNT(*) AS outside FROM (SELECT DISTINCT customer_state FROM matrix "
            "WHERE customer_state NOT IN (SELECT customer_state FROM train))"]
    for name, kind in FEATURES[1:]:
        rows.append(f"SELECT '{name}', COUNT(*) FILTER (WHERE {name} < (SELECT MIN({name}) FROM train) OR "
                    f"{name} > (SELECT MAX({name}) FROM train)) FROM matrix")
    return " UNION ALL ".join(rows)


@query("d14_domain_warnings", with_base(_domain_sql(), sql.PANEL, sql.SPLIT, TRAIN, sql.MATRIX))
def domain_warnings(spark, folder):
    features = train_features(spark, folder)
    rows = contract.domain_warnings(
        contract.feature_blueprint(features), contract.category_values(features), matrix(spark, folder)
    )
    return rows.select("feature", F.col("observed").cast("bigint").alias("outside"))
