"""The stored state against features computed from all days, whatever order the days came in."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from registered import storage  # noqa: F401
from registered.registry import QUERIES
from tests.orders import CUSTOMERS, ORDERS, PAYMENTS, order
from tidemark.functions.times import snapshot
from tidemark.operators.features import point_in_time_features
from tidemark.sources.tables import typed_tables
from tidemark.streaming import state, versions

START = date(2018, 6, 1)
DAYS = [START + timedelta(days=i) for i in range(8)]


def parts(df, rows):
    """Day columns: the last entry of each row is its day."""
    moment = F.to_date("of_day")
    return df.select(*[c for c in df.columns if c != "of_day"], *[F.date_format(moment, f).alias(n) for f, n in (("yyyy", "year"), ("MM", "month"), ("dd", "day"))])


def day_rows(rng, day, orders=6):
    """Orders of one day with unknown persons, repeated links, payments and orders, and missing values."""
    out = {"orders": [], "customers": [], "payments": []}
    for i in range(orders):
        name, customer = f"{day:%d}-{i}", f"c{day:%d}-{i}"
        delivered = rng.choice([None, f"{day + timedelta(days=rng.randint(1, 9))}"])
        status = rng.choice(["delivered", "shipped", "canceled"])
        row = order(rng.choice([name, name, None]), rng.choice([customer, customer, None]), f"{day} {rng.randint(10, 20)}:00:00", f"{day}", delivered, status)
        out["orders"] += [(*row, f"{day}")] * rng.choice([1, 1, 2])
        out["customers"] += [(customer, rng.choice([None, "hot", "hot", f"p{rng.randint(0, 9)}"]), rng.choice([None, "A", "B"]), f"{day}")] * rng.choice([1, 2])
        out["payments"] += [(name, rng.choice([None, 1.5, 20.25]), f"{day}") for _ in range(rng.randint(0, 2))]
    return out


def lake_tables(spark, days):
    shapes = {"orders": ORDERS, "customers": CUSTOMERS, "payments": PAYMENTS}
    return {n: parts(spark.createDataFrame([r for d in days for r in d[n]], f"{s}, of_day string"), None) for n, s in shapes.items()}


def features(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rebuilt(spark, lake, at):
    tables = {n: df.drop("year", "month", "day") for n, df in versions.read_version(spark, lake).items()}
    return features(point_in_time_features(typed_tables(**tables), at))


def test_equals_a_rebuild_after_every_change(spark, tmp_path):
    rng = random.Random(3)
    lake, root = str(tmp_path / "lake"), str(tmp_path / "state")
    steps = [DAYS[:2], DAYS[2:3], DAYS[4:6], DAYS[3:4], DAYS[1:2], DAYS[6:]]  # in turn, a late day, a rewritten one
    for step in steps:
        versions.publish(lake_tables(spark, [day_rows(rng, d) for d in step]), lake)
        assert state.update(spark, lake, root, buckets=4, keep=2) == [d.isoformat() for d in step]
        for at in (snapshot("2018-06-04"), snapshot("2018-07-01")):
            assert features(state.features_at(spark, root, at)) == rebuilt(spark, lake, at)
    assert state.update(spark, lake, root) == []
    empty = {n: df.limit(0) for n, df in lake_tables(spark, [day_rows(rng, DAYS[0])]).items()}
    for day in (DAYS[4], DAYS[7]):  # one in the middle, then the last: replaced by nothing
        versions.publish(empty, lake, [day])
        assert state.update(spark, lake, root) == [day.isoformat()]
        at = snapshot("2018-07-01")
        assert features(state.features_at(spark, root, at)) == rebuilt(spark, lake, at)
    assert not spark.sql("SHOW TABLES LIKE 'keyed_*'").collect()
    assert len(state.state_manifest(spark, root)[1]["states"]) <= 2 < len(list(tmp_path.glob("state/states/*")))
    assert len(list(state.unused_folders(spark, root))) >= 2


def test_only_changed_days_are_read_and_the_state_stays_in_place(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    lake, root = str(tmp_path / "lake"), str(tmp_path / "state")
    versions.publish(lake_tables(spark, [day_rows(rng, d) for d in DAYS[:6]]), lake)
    state.update(spark, lake, root, buckets=4)
    versions.publish(lake_tables(spark, [day_rows(rng, d) for d in DAYS[6:]]), lake)
    read, merged = [], []
    real_summaries, real_write = state.batch_summaries, state.write_buckets
    monkeypatch.setattr(state, "batch_summaries", lambda tables: read.extend(tables.values()) or real_summaries(tables))
    monkeypatch.setattr(state, "write_buckets", lambda df, *rest: merged.append(df) or real_write(df, *rest))
    state.update(spark, lake, root)
    files = [f for df in read for f in df.inputFiles()]
    assert files and all("day=07" in f or "day=08" in f for f in files)
    plan = merged[0]._jdf.queryExecution().executedPlan().toString()
    lines = plan[plan.index("Join") :].splitlines()[1:]
    old = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    # Between the join and the scan of the state there is no exchange; the days since are moved once.
    assert not any("Exchange" in line for line in lines[: old + 1]) and plan.count("Exchange") == 1, plan


def test_a_stopped_update_leaves_the_old_state(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    lake, root = str(tmp_path / "lake"), str(tmp_path / "state")
    at = snapshot("2018-07-01")
    versions.publish(lake_tables(spark, [day_rows(rng, DAYS[0])]), lake)
    state.update(spark, lake, root, buckets=2)
    before = features(state.features_at(spark, root, at))
    versions.publish(lake_tables(spark, [day_rows(rng, DAYS[1])]), lake)
    with monkeypatch.context() as patch:
        patch.setattr(state, "commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            state.update(spark, lake, root)
    assert features(state.features_at(spark, root, at)) == before
    assert state.update(spark, lake, root) == [DAYS[1].isoformat()]
    assert features(state.features_at(spark, root, at)) == rebuilt(spark, lake, at)


def test_orders_outside_their_batch_are_refused(spark, tmp_path):
    lake, root = str(tmp_path / "lake"), str(tmp_path / "state")
    rows = day_rows(random.Random(7), DAYS[3])
    rows["orders"] = [(*order("x", "c", "2018-06-01"), "2018-06-04")]
    rows["customers"] = [("c", "p", "A", "2018-06-04")]
    versions.publish(lake_tables(spark, [rows]), lake)
    with pytest.raises(Exception, match="older than its batch 2018-06-04"):
        state.update(spark, lake, root)
    assert state.features_at(spark, root, snapshot("2018-07-01")) is None


def test_stream_over_versions_survives_restarts(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    lake, root, checkpoint = (str(tmp_path / n) for n in ("lake", "state", "checkpoint"))
    at = snapshot("2018-07-01")
    done, real = [], state.update
    monkeypatch.setattr(state, "update", lambda *args: done.append(real(*args)))

    def run():
        stream = state.follow(spark, lake, root, checkpoint, buckets=2)
        stream.awaitTermination(120)
        assert stream.exception() is None
        stream.stop()

    versions.publish(lake_tables(spark, [day_rows(rng, d) for d in DAYS[:2]]), lake)
    run()
    assert features(state.features_at(spark, root, at)) == rebuilt(spark, lake, at)
    with monkeypatch.context() as patch:  # files of a day are there, but no version names them: the day waits
        patch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            versions.publish(lake_tables(spark, [day_rows(rng, DAYS[2])]), lake)
    run()
    versions.publish(lake_tables(spark, [day_rows(rng, DAYS[2])]), lake)
    run()
    run()
    assert [d for d in done if d] == [[d.isoformat() for d in DAYS[:2]], [DAYS[2].isoformat()]]
    assert features(state.features_at(spark, root, at)) == rebuilt(spark, lake, at)


def test_published_versions_read_stored_days(spark, folder, monkeypatch):
    """The registered query joins orders and line items once, not for each version."""
    read, publish = [], versions.publish
    monkeypatch.setattr(versions, "publish", lambda tables, root: read.extend(f for df in tables.values() for f in df.inputFiles()) or publish(tables, root))
    QUERIES["s13_incremental_state"](spark, folder)
    assert read
    assert not [f for f in read if "lineitem" in f or "orders.parquet" in f]
