import pytest

from tidemark.operators import quality

RULES = {
    "tables": {
        "t": {
            "num_columns": 3,
            "columns": {
                "id": {"dtype": "VARCHAR", "unique": True},
                "kind": {"dtype": "VARCHAR", "allowed_values": ["a", "b"], "max_missing_percentage": 0.5},
                "n": {"dtype": "BIGINT", "allowed_values": [1, 2]},
            },
        }
    }
}
SCHEMA = "id string, kind string, n bigint"
GOOD = [("1", "a", 1), ("2", None, 2)]


def failed(spark, rows, schema=SCHEMA, rules=RULES):
    checks = quality.check_tables(spark, {"t": spark.createDataFrame(rows, schema)}, rules)
    return {(r["column_name"], r["rule"]) for r in checks.filter("NOT passed").collect()}


def test_good_table_passes(spark):
    checks = quality.check_tables(spark, {"t": spark.createDataFrame(GOOD, SCHEMA)}, RULES)
    assert quality.gate_is_open(checks)
    assert quality.proven_unique(checks) == {("t", "id")}
    assert tuple(quality.overall_result(checks).first()) == (1, 1, 0, True)


@pytest.mark.parametrize(
    "rows, schema, expected",
    [
        ([("1", "a", 1), ("1", "b", 2)], SCHEMA, {("id", "unique")}),
        ([("1", "c", 1), ("2", "b", 2)], SCHEMA, {("kind", "allowed_values")}),
        ([("1", "a", 3), ("2", "b", 2)], SCHEMA, {("n", "allowed_values")}),
        ([("1", None, 1), ("2", None, 2)], SCHEMA, {("kind", "missing_share")}),
        ([(None, "a", 1), (None, "b", 2)], SCHEMA, {("id", "unique"), ("id", "missing_share")}),
        (GOOD, "id string, kind string, n int", {("n", "data_type")}),
        ([(1, "a", "1"), (2, "b", "x")], "id bigint, kind string, n string",
         {("id", "data_type"), ("n", "data_type"), ("n", "allowed_values")}),
        ([("1", "a")], "id string, kind string", {(None, "column_count"), ("n", "column_present")}),
        ([], SCHEMA, set()),
    ],
)
def test_each_rule_fails_alone(spark, rows, schema, expected):
    assert failed(spark, rows, schema) == expected


def test_share_at_the_limit_passes(spark):
    assert failed(spark, GOOD) == set()


def test_missing_table(spark):
    checks = quality.check_tables(spark, {}, RULES)
    assert not quality.gate_is_open(checks)
    lenient = RULES | {"validation_rules": {"allow_missing_tables": True}}
    assert quality.gate_is_open(quality.check_tables(spark, {}, lenient))


def test_tables_without_rules_are_not_checked(spark):
    extra = spark.createDataFrame([(1,)], "x int")
    checks = quality.check_tables(spark, {"t": spark.createDataFrame(GOOD, SCHEMA), "extra": extra}, RULES)
    assert [r["table_name"] for r in quality.table_results(checks).collect()] == ["t"]


def test_profile_of_empty_table(spark):
    rows = quality.profile(spark.createDataFrame([], SCHEMA), "t").collect()
    assert [(r["column_name"], r["num_rows"], r["missing_values"]) for r in rows] == [
        ("id", 0, 0), ("kind", 0, 0), ("n", 0, 0)
    ]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("x", None)], "`a b` string, `c.d` string")
    rows = quality.profile(df, "t").collect()
    assert [(r["column_name"], r["missing_values"]) for r in rows] == [("a b", 0), ("c.d", 1)]


def test_declared_schema():
    assert quality.declared_schema(RULES["tables"]["t"]).simpleString() == "struct<id:string,kind:string,n:bigint>"


def test_raw_table_rules_are_well_formed():
    from tidemark.sources.raw_rules import RAW_RULES

    assert {t: r["num_columns"] for t, r in RAW_RULES["tables"].items()} == {
        "orders": 8, "customers": 5, "order_items": 7, "payments": 5, "reviews": 7, "products": 9, "sellers": 4
    }
    for rules in RAW_RULES["tables"].values():
        assert len(rules["columns"]) == rules["num_columns"]
        quality.declared_schema(rules)
