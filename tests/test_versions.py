"""Publication by versions, and what is left after a writer was stopped anywhere."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import versions

DAYS = "order_id string, value int, year string, month string, day string"
FIRST, SECOND, THIRD = date(2018, 6, 9), date(2018, 6, 10), date(2018, 7, 1)


def lake(spark, *rows):
    return spark.createDataFrame([(i, v, f"{d:%Y}", f"{d:%m}", f"{d:%d}") for i, v, d in rows], DAYS)


def content(tables):
    return {name: sorted((r.order_id, r.value, int(r.month), r.day) for r in df.collect()) for name, df in tables.items()}


@pytest.fixture
def root(spark, tmp_path):
    """Version 1: two days of two tables."""
    place = str(tmp_path / "lake")
    orders = lake(spark, ("a", 1, FIRST), ("b", 2, SECOND))
    assert versions.publish({"orders": orders, "payments": lake(spark, ("a", 10, FIRST), ("b", 20, SECOND))}, place) == 1
    return place


V1 = {"orders": [("a", 1, 6, "09"), ("b", 2, 6, "10")], "payments": [("a", 10, 6, "09"), ("b", 20, 6, "10")]}


def test_days_are_replaced_and_old_versions_stay(spark, root):
    assert content(versions.read_version(spark, root)) == V1
    pinned = versions.read_version(spark, root)
    assert versions.publish({"orders": lake(spark, ("c", 3, SECOND), ("d", None, THIRD))}, root) == 2
    new = {**V1, "orders": [("a", 1, 6, "09"), ("c", 3, 6, "10"), ("d", None, 7, "01")]}
    assert content(versions.read_version(spark, root)) == new
    assert content(pinned) == content(versions.read_version(spark, root, 1)) == V1
    assert versions.read_version(spark, root)["orders"].columns == ["order_id", "value", "year", "month", "day"]


def test_days_replaced_by_nothing(spark, root):
    empty = lake(spark, ("x", 0, FIRST)).limit(0)
    versions.publish({"orders": empty, "payments": lake(spark, ("a", 11, FIRST))}, root, [FIRST])
    assert content(versions.read_version(spark, root)) == {"orders": V1["orders"][1:], "payments": [("a", 11, 6, "09"), V1["payments"][1]]}
    versions.publish({"orders": empty}, root, [SECOND])
    assert content(versions.read_version(spark, root))["orders"] == []
    with pytest.raises(ValueError, match="2018-06-10"):
        versions.publish({"orders": lake(spark, ("b", 2, SECOND))}, root, [FIRST])


@pytest.mark.parametrize("stop", ["within a table", "between tables", "before the version"])
def test_a_stopped_writer_changes_nothing(spark, root, stop, monkeypatch):
    """The writer is stopped after some files of the new days are there; the same publication works afterwards."""
    good = lake(spark, ("c", 3, FIRST), ("d", 4, SECOND))
    bad = good.withColumn("value", F.when(F.col("order_id") == "d", F.raise_error(F.lit("stopped")).cast("int")).otherwise(1))
    tables = {"orders": bad if stop == "within a table" else good, "payments": bad if stop == "between tables" else good}
    with monkeypatch.context() as patch:
        if stop == "before the version":
            patch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(Exception, match="stopped"):
            versions.publish(tables, root)
    assert versions.list_versions(spark, root) == [1] and content(versions.read_version(spark, root)) == V1
    assert versions.publish({"orders": good, "payments": good}, root) == 2
    assert content(versions.read_version(spark, root))["payments"] == [("c", 3, 6, "09"), ("d", 4, 6, "10")]


def test_two_writers(spark, root, monkeypatch):
    """Another writer commits after this one has read the newest version: its days are kept."""
    real, calls = versions.commit, []

    def overtaken(*args):
        if not calls:
            calls.append(1)
            versions.publish({"orders": lake(spark, ("z", 9, THIRD))}, root)
        return real(*args)

    monkeypatch.setattr(versions, "commit", overtaken)
    assert versions.publish({"orders": lake(spark, ("c", 3, FIRST))}, root) == 3
    assert content(versions.read_version(spark, root))["orders"] == [("b", 2, 6, "10"), ("c", 3, 6, "09"), ("z", 9, 7, "01")]
    assert not list(Path(root, versions.VERSIONS).glob(".draft*"))


def test_expire(spark, root):
    for value in (5, 6, 7):
        versions.publish({"orders": lake(spark, ("a", value, FIRST))}, root)
    assert versions.expire(spark, root, keep=2) == [1, 2] and versions.expire(spark, root, keep=2) == []
    assert versions.list_versions(spark, root) == [3, 4]
    assert content(versions.read_version(spark, root, 3)) == {**V1, "orders": [("a", 6, 6, "09"), V1["orders"][1]]}
    assert content(versions.read_version(spark, root)) == {**V1, "orders": [("a", 7, 6, "09"), V1["orders"][1]]}
    assert len(list(Path(root, "orders").glob("write=*/year=*/month=*/day=09"))) == 2
    with pytest.raises(ValueError):
        versions.expire(spark, root, keep=0)


def test_columns_come_and_go_but_keep_their_type(spark, root):
    versions.publish({"orders": lake(spark, ("c", 3, SECOND)).withColumn("note", F.lit("new"))}, root)
    rows = {r.order_id: r.note for r in versions.read_version(spark, root)["orders"].collect()}
    assert rows == {"a": None, "c": "new"}
    with pytest.raises(ValueError, match="orders.value is int, not string"):
        versions.publish({"orders": lake(spark, ("c", 3, SECOND)).withColumn("value", F.lit("3"))}, root)
    assert len(versions.list_versions(spark, root)) == 2


def test_only_named_folders_are_read(spark, root):
    versions.publish({"orders": lake(spark, ("c", 3, SECOND))}, root)
    orders = versions.read_version(spark, root)["orders"].filter("day = '10'")
    assert len(orders.inputFiles()) == 2  # before pruning: a file for each day of the version, none of the replaced one
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and orders.collect()[0].order_id == "c"


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, str(tmp_path))
