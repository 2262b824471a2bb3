import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from registered import sql
from tests.orders import AT, by_person, order, tables
from tidemark.functions.times import days_between, parse_timestamp, snapshot
from tidemark.columns import FEATURE_COLUMNS, PANEL_COLUMNS
from tidemark.operators.features import point_in_time_features
from tidemark.operators.targets import forward_targets
from tidemark.plans.panel import PLANS, build_panel, cell_of, cut_points, panel_profile


def test_cutoff_is_strict_and_window_is_half_open(spark):
    people = ["before", "at", "last", "end"]
    bought = {
        "before": "2017-08-31 23:59:59",
        "at": "2017-09-01 00:00:00",
        "last": "2018-02-27 23:59:59",
        "end": "2018-02-28 00:00:00",
    }
    t = tables(
        spark,
        [order(p, p, bought[p]) for p in people],
        [(p, p, "SP") for p in people],
        [(p, 1.0) for p in people],
    )
    assert set(by_person(point_in_time_features(t, AT))) == {"before"}
    assert set(by_person(forward_targets(t, AT, 180))) == {"at", "last"}
    assert by_person(point_in_time_features(t, AT))["before"]["recency_days"] == 1


@pytest.mark.parametrize(
    "text, kept",
    [
        ("2017", False),
        ("2017-09", False),
        (" 2017-09-01 ", False),
        ("", False),
        ("2017-02-30", False),
        ("2017-09-01 ", False),
        ("2017-09-01 10", False),
        ("2017/09/01", True),
        ("2017-09-01 24:00:00", True),
        ("2017-09-01  10:00:00", True),
        (None, False),
        ("2017-9-1", True),
        ("2017-09-01T10:00:00Z", True),
        ("2017-09-01 10:00:00+02:00", True),
        ("2017-09-01 10:00:00.123", True),
    ],
)
def test_timestamp_texts(spark, text, kept):
    row = spark.createDataFrame([(text,)], "x string").select(parse_timestamp(F.col("x")).alias("t")).first()
    assert (row["t"] is not None) == kept
    if kept and "10:00:00" in text:
        assert row["t"].hour == 10


def test_day_boundaries(spark):
    df = spark.sql("SELECT timestamp_ntz'2017-08-31 23:59:59' AS a, timestamp_ntz'2017-09-01 00:00:00' AS b")
    assert df.select(days_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_unreadable_purchase_time_drops_the_order(spark):
    t = tables(spark, [order("1", "c", "2017"), order("2", "c", "2017-08-01")], [("c", "p", "SP")], [])
    assert by_person(point_in_time_features(t, AT))["p"]["frequency"] == 1


def test_joins_and_money(spark):
    t = tables(
        spark,
        [
            order("paid", "a", "2017-08-01"),
            order("unpaid", "b", "2017-08-02"),
            order("nobody", "x", "2017-08-02"),
            order("copied", "d", "2017-08-03", status="canceled"),
        ],
        [("a", "A", "SP"), ("b", "B", "RJ"), ("d", "D", "MG"), ("d", "D", "SP")],
        [("paid", 1.5), ("paid", 2.5), ("paid", 6.0), ("copied", 7.0)],
    )
    rows = by_person(point_in_time_features(t, AT))
    assert set(rows) == {"A", "B", "D"}
    assert (rows["A"]["frequency"], rows["A"]["monetary_total"], rows["A"]["aov"]) == (1, 10.0, 10.0)
    assert (rows["B"]["monetary_total"], rows["B"]["aov"]) == (0.0, 0.0)
    # a repeated customer id doubles money and cancellations, not orders
    assert (rows["D"]["frequency"], rows["D"]["monetary_total"], rows["D"]["total_canceled_orders"]) == (1, 14.0, 2)
    assert rows["D"]["customer_state"] == "SP"


def test_delivery_measures(spark):
    t = tables(
        spark,
        [
            order("1", "never", "2017-08-01", delivered=None, status="shipped"),
            order("2", "early", "2017-08-01", due="2017-08-20", delivered="2017-08-15"),
            order("3", "late", "2017-08-01", due="2017-08-20", delivered="2017-09-02"),
        ],
        [(c, c, "SP") for c in ("never", "early", "late")],
        [],
    )
    rows = by_person(point_in_time_features(t, AT))
    assert (rows["never"]["max_delivery_delay_days"], rows["never"]["has_undelivered_order"]) == (None, 1)
    assert (rows["early"]["max_delivery_delay_days"], rows["early"]["has_undelivered_order"]) == (-5, 0)
    assert rows["late"]["max_delivery_delay_days"] == 13
    strict = by_person(point_in_time_features(t, AT, strict_as_of=True))
    assert (strict["late"]["max_delivery_delay_days"], strict["late"]["has_undelivered_order"]) == (None, 1)
    assert strict["early"]["max_delivery_delay_days"] == -5


SNAPSHOTS = [snapshot(s) for s in ("2017-09-01", "2017-11-01", "2018-01-01", "2018-03-01")]


def awkward_rows():
    """Repeated and missing ids, repeated customers, an order id in several cells, one hot person."""
    orders = [
        order("1", "a", "2017-08-01"),
        order("1", "a", "2017-10-01"),
        order("1", "a2", "2017-12-01"),
        order("2", "a", "2017-09-01"),
        order(None, "a", "2017-08-05"),
        order(None, "only_null", "2017-08-05"),
        order("3", "no_person", "2017-08-05"),
        order("4", "no_person", "2017-10-05"),
        order("5", "late", "2017-12-05", status="canceled"),
        order("6", "late", "2018-02-05", status="canceled"),
        order("7", "gone", "2017-08-05", delivered=None, status="unavailable"),
        order("8", "unpaid", "2017-08-05"),
        order("9", "unpaid", "2017-10-05"),
        order("10", "stranger", "2017-10-05"),
        order("11", None, "2017-10-05"),
    ]
    orders += [order(f"h{i}", f"hot{i % 3}", f"2017-{3 + i % 9:02d}-{1 + i % 27:02d}") for i in range(60)]
    orders += [order("same", "hot0", "2017-08-01")] * 20
    customers = [
        ("a", "A", "SP"), ("a2", "A", "RJ"), ("a", "A", "MG"), ("only_null", "N", "SP"), ("no_person", None, "SP"),
        ("late", "L", "BA"), ("gone", "G", None), ("unpaid", "U", "SP"), ("hot0", "H", "SP"), ("hot1", "H", "SP"),
        ("hot2", "H", "RJ"), ("a", "A3", "SP"), (None, "X", "SP"),
    ]
    payments = [("1", 10.0), ("1", 5.0), ("2", 7.0), ("3", 1.0), ("4", 2.0), ("5", 3.0), (None, 99.0)]
    payments += [(f"h{i}", float(i)) for i in range(60)] + [("same", 2.0)] * 5
    return orders, customers, payments


def awkward_tables(spark):
    return tables(spark, *awkward_rows())


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_plans_give_the_same_rows(spark):
    t = awkward_tables(spark)
    expected = rows_of(build_panel(t, SNAPSHOTS, plan="union", stamp=False))
    assert len(expected) > 15
    for plan in PLANS:
        assert rows_of(build_panel(t, SNAPSHOTS, plan=plan, stamp=False)) == expected
    # one and many snapshots, overlapping and separate windows
    for days, labels in ((1, ["2017-09-01"]), (400, ["2017-09-01", "2017-09-02", "2017-12-01"])):
        some = [snapshot(s) for s in labels]
        expected = rows_of(build_panel(t, some, days, "union", stamp=False))
        assert rows_of(build_panel(t, some, days, "cells", stamp=False)) == expected
        assert rows_of(build_panel(t, some, days, "fan_out", stamp=False)) == expected


def random_rows(seed):
    """Few ids and many rows, so that everything repeats and much is missing."""
    rng = random.Random(seed)

    def some(*values):
        return rng.choice([*values, None])

    def day():
        return f"{rng.choice([2017, 2018])}-{rng.randrange(1, 13):02d}-{rng.choice([1, 15, 28]):02d}"

    orders = [
        order(some(*"abcdefghijkl"), some(*"123456"), some(day(), day(), "2017", day()), some(day(), day()),
              some(day(), day()), some("delivered", "shipped", "canceled", "created"))
        for _ in range(150)
    ]
    customers = [(some(*"1234567"), some("P", "Q", "R"), some("SP", "RJ")) for _ in range(12)]
    payments = [(some(*"abcdefgh"), some(1.0, 2.5, 4.0)) for _ in range(40)]
    return orders, customers, payments


def sql_panel(orders, customers, payments):
    """The panel as plain SQL, with every join row by row."""
    con = duckdb.connect()
    con.execute("CREATE TABLE raw (order_id VARCHAR, customer_id VARCHAR, bought VARCHAR, due VARCHAR, came VARCHAR, s VARCHAR)")
    con.executemany("INSERT INTO raw VALUES (?, ?, ?, ?, ?, ?)", orders)
    con.execute("CREATE TABLE c (customer_id VARCHAR, customer_unique_id VARCHAR, customer_state VARCHAR)")
    con.executemany("INSERT INTO c VALUES (?, ?, ?)", customers)
    con.execute("CREATE TABLE pay (order_id VARCHAR, payment_value DOUBLE)")
    con.executemany("INSERT INTO pay VALUES (?, ?)", payments)
    con.execute(
        "CREATE VIEW o AS SELECT order_id, customer_id, TRY_CAST(bought AS TIMESTAMP) AS purchase_ts, "
        "TRY_CAST(due AS TIMESTAMP) AS est_delivery_ts, TRY_CAST(came AS TIMESTAMP) AS act_delivery_ts, "
        "s AS order_status FROM raw"
    )
    con.execute("CREATE VIEW opay AS SELECT order_id, SUM(payment_value) AS order_payment_value FROM pay GROUP BY order_id")
    rows = con.execute(" UNION ALL ".join(sql.panel_part(s.label) for s in SNAPSHOTS)).fetchall()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_panel_against_row_by_row_sql(spark, seed):
    rows = awkward_rows() if seed is None else random_rows(seed)
    expected = sql_panel(*rows)
    assert len(expected) >= 8
    for plan in PLANS:
        assert rows_of(build_panel(tables(spark, *rows), SNAPSHOTS, plan=plan, stamp=False)) == expected


def test_unique_orders_with_repeated_customers(spark):
    """Order ids unique, customer ids not: copies in different states must not count an order twice."""
    t = tables(
        spark,
        [order("1", "a", "2017-08-01"), order("2", "a", "2017-10-01"), order("3", "b", "2017-12-01")],
        [("a", "A", "SP"), ("a", "A", "RJ"), ("a", "A", "RJ"), ("b", "A", "MG"), ("b", "B", "MG")],
        [("1", 5.0), ("2", 7.0), ("3", 9.0)],
    )
    expected = rows_of(build_panel(t, SNAPSHOTS, plan="union", stamp=False))
    for proven in (False, True):
        for plan in PLANS:
            some = t.with_proofs(unique_orders=proven, unique_customers=False)
            assert rows_of(build_panel(some, SNAPSHOTS, plan=plan, stamp=False)) == expected
    first = by_person(point_in_time_features(t, AT))["A"]
    assert (first["frequency"], first["monetary_total"], first["customer_state"]) == (1, 15.0, "SP")


def test_awkward_values(spark):
    panel = build_panel(awkward_tables(spark), SNAPSHOTS, stamp=False)
    at = {(r["customer_unique_id"], r["snapshot_date"]): r for r in panel.collect()}
    assert ("N", "2017-09-01") not in at  # no order id at all
    assert at[("A", "2017-11-01")]["frequency"] == 2
    assert at[("A", "2018-01-01")]["frequency"] == 2  # the repeated id counts once
    assert (at[(None, "2017-09-01")]["target_is_churn"], at[(None, "2017-09-01")]["target_180d_ltv"]) == (1, 0.0)
    assert at[("L", "2018-01-01")]["target_is_churn"] == 1  # only canceled orders follow
    assert (at[("U", "2017-09-01")]["target_is_churn"], at[("U", "2017-09-01")]["target_180d_ltv"]) == (0, 0.0)
    assert ("stranger", "2017-11-01") not in at


def test_panel_columns_and_stamp(spark):
    panel = build_panel(awkward_tables(spark), SNAPSHOTS)
    assert panel.columns == PANEL_COLUMNS
    kinds = [f.dataType.simpleString() for f in panel.schema.fields]
    assert kinds == ["string", "string", "bigint", "bigint", "bigint", "double", "double", "bigint", "int", "bigint",
                     "string", "double", "int", "timestamp_ntz"]
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((panel.first()["ingested_at_utc"] - now).total_seconds()) < 600


def test_training_and_scoring_use_the_same_features(spark):
    t = awkward_tables(spark)
    panel = build_panel(t, SNAPSHOTS, stamp=False)
    for s in SNAPSHOTS:
        part = panel.filter(F.col("snapshot_date") == s.label).select(*FEATURE_COLUMNS)
        assert rows_of(part) == rows_of(point_in_time_features(t, s))


def test_later_orders_never_change_features(spark):
    t = awkward_tables(spark)
    before = rows_of(point_in_time_features(t, AT))
    more = t.orders.withColumn("purchase_ts", F.col("purchase_ts") + F.expr("INTERVAL '3650' DAY"))
    import dataclasses

    later = dataclasses.replace(t, orders=t.orders.unionByName(more))
    assert rows_of(point_in_time_features(later, AT)) == before
    for row in before:
        assert row[2] <= row[3]


def test_proven_unique_ids_change_nothing(spark, folder):
    from tidemark.sources import sample_data

    t = sample_data.order_tables(spark, folder)
    plain = rows_of(build_panel(t, sample_data.SNAPSHOTS, stamp=False))
    proven = t.with_proofs(unique_orders=True, unique_customers=True)
    for plan in PLANS:
        assert rows_of(build_panel(proven, sample_data.SNAPSHOTS, plan=plan, stamp=False)) == plain


def test_cells(spark):
    cuts = cut_points(SNAPSHOTS[:2], 30)
    moments = [(c,) for c in cuts] + [(cuts[0] - dt.timedelta(seconds=1),)]
    df = spark.createDataFrame(moments, "t timestamp_ntz")
    assert [r[0] for r in df.select(cell_of(F.col("t"), cuts)).collect()] == [1, 2, 3, 4, 0]


def test_empty_panel_profile(spark):
    panel = build_panel(awkward_tables(spark), [snapshot("2000-01-01")], stamp=False)
    assert tuple(panel_profile(panel).first()) == (0, 0.0)


def test_snapshot_forms():
    assert snapshot(dt.date(2017, 9, 1)) == AT
    assert snapshot("2017-09-01 12:30:00").at == dt.datetime(2017, 9, 1, 12, 30)
    with pytest.raises(ValueError):
        snapshot("yesterday")


def test_strict_panel_has_strict_features(spark):
    t = awkward_tables(spark)
    panel = build_panel(t, SNAPSHOTS, stamp=False, plan="union", strict_as_of=True)
    for s in SNAPSHOTS:
        part = panel.filter(F.col("snapshot_date") == s.label).select(*FEATURE_COLUMNS)
        assert rows_of(part) == rows_of(point_in_time_features(t, s, strict_as_of=True))


@pytest.mark.parametrize("seed", [None, 1, 2, 3])
def test_strict_cells_equal_strict_union(spark, seed):
    rows = awkward_rows() if seed is None else random_rows(seed)
    t = tables(spark, *rows)
    parts = [rows_of(build_panel(t, SNAPSHOTS, stamp=False, plan=p, strict_as_of=True)) for p in ("cells", "running", "union")]
    assert parts[0] == parts[1] == parts[2] and parts[0]
    with pytest.raises(ValueError, match="strict_as_of"):
        build_panel(t, SNAPSHOTS, plan="fan_out", strict_as_of=True)


@pytest.mark.parametrize("seed", [None, 4])
@pytest.mark.parametrize("step, days", [(1, 7), (5, 180), (11, 3)])
@pytest.mark.parametrize("strict", [False, True])
def test_running_panel_over_many_snapshots(spark, seed, step, days, strict):
    """Windows longer and shorter than the step, snapshots before the first and after the last order."""
    t = tables(spark, *(awkward_rows() if seed is None else random_rows(seed)))
    many = [snapshot(dt.date(2017, 6, 1) + dt.timedelta(days=step * i)) for i in range(70)]
    parts = [
        rows_of(build_panel(t, many[::-1], days, stamp=False, plan=p, strict_as_of=strict)) for p in ("cells", "running")
    ]
    assert parts[0] == parts[1] and parts[0]


def test_running_panel_within_a_day_and_repeated_snapshots(spark):
    t = tables(spark, *random_rows(5))
    times = [snapshot(f"2017-10-0{d} {h:02}:30:00") for d in range(1, 8) for h in (0, 7, 19)]
    times += [times[3]._replace(label="again")]
    parts = [rows_of(build_panel(t, times, 20, stamp=False, plan=p)) for p in ("cells", "running")]
    assert parts[0] == parts[1] and parts[0]


def test_running_panel_without_orders(spark):
    t = tables(spark, [], [], [])
    assert build_panel(t, SNAPSHOTS, stamp=False, plan="running").count() == 0
