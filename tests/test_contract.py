from tidemark.operators import contract

EXPECTED = [("state", "string"), ("days", "bigint"), ("money", "double")]


def wrong(actual):
    return {(name, rule) for name, rule, passed, _, _ in contract.structure_rules(EXPECTED, actual) if not passed}


def test_structure_rules():
    assert wrong(EXPECTED) == set()
    assert wrong(EXPECTED + [("extra", "int")]) == set()
    assert wrong([EXPECTED[1], EXPECTED[0], EXPECTED[2]]) == {("state", "position"), ("days", "position")}
    assert wrong(EXPECTED[1:]) == {("state", "present"), ("days", "position"), ("money", "position")}
    assert wrong([("state", "string"), ("days", "double"), ("money", "bigint")]) == {("days", "type")}


def test_type_slots():
    assert contract.fits_slot("float64", "BIGINT") and contract.fits_slot("double", "bigint")
    assert not contract.fits_slot("int64", "DOUBLE") and not contract.fits_slot("bigint", "double")
    assert contract.fits_slot("category", "VARCHAR") and contract.fits_slot("object", "string")
    assert contract.fits_slot("decimal", "decimal") and not contract.fits_slot("decimal", "double")


SCHEMA = "state string, days bigint, flag int, money double, nothing double"


def test_blueprint_and_domains(spark):
    df = spark.createDataFrame(
        [("b", 5, 0, 1.5, None), ("a", 7, 1, None, None), (None, 9, 1, 3.0, None)], SCHEMA
    )
    rows = {r["name"]: r for r in contract.feature_blueprint(df).collect()}
    assert [rows[c]["logical_type"] for c in df.columns] == [
        "categorical", "numerical", "boolean_indicator", "numerical", "boolean_indicator"
    ]
    assert [rows[c]["is_nullable"] for c in df.columns] == [True, False, False, True, True]
    assert (rows["days"]["min"], rows["days"]["max"]) == (5.0, 9.0)
    assert rows["flag"]["allowed_values"] == [0, 1] and rows["nothing"]["allowed_values"] == []
    values = contract.category_values(df).orderBy("value").collect()
    assert [(r["name"], r["value"]) for r in values] == [("state", "a"), ("state", "b")]
    assert contract.blueprint_features(contract.feature_blueprint(df))[1] == ("days", "bigint")


def test_domain_warnings_do_not_close_the_gate(spark):
    train = spark.createDataFrame([("a", 5, 0, 1.5, None), ("b", 7, 1, 2.0, None)], SCHEMA)
    other = spark.createDataFrame([("z", 8, 2, 1.0, 4.0), ("a", 6, 1, 1.6, None)], SCHEMA)
    blueprint, values = contract.feature_blueprint(train), contract.category_values(train)
    rows = contract.domain_warnings(blueprint, values, other).collect()
    assert {r["feature"]: r["observed"] for r in rows} == {
        "state": "1", "days": "1", "flag": "1", "money": "1", "nothing": "0"
    }
    assert {r["severity"] for r in rows} == {"warn"}
    checks = contract.check_contract(contract.blueprint_features(blueprint), other)
    assert contract.contract_result(checks).first()["is_valid"]


def test_empty_matrix_is_an_error_and_nothing_else_is_looked_at(spark):
    empty = spark.createDataFrame([], "customer_unique_id string, days double")
    checks = contract.check_contract(EXPECTED, empty)
    assert [(r["rule"], r["passed"]) for r in checks.collect()] == [("population", False)]
    assert not contract.contract_result(checks).first()["is_valid"]


def test_matrix_schema(spark):
    df = spark.createDataFrame([], "customer_unique_id string, a int, snapshot_date string, b double")
    rows = [(r["name"], r["role"], r["index"]) for r in contract.matrix_schema(df).collect()]
    assert rows == [
        ("customer_unique_id", "entity", None), ("a", "feature", 0), ("snapshot_date", "entity", None),
        ("b", "feature", 1),
    ]
