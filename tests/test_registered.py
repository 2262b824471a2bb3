"""Every registered query on the sample tables: equal to its SQL where it has one, else with rows."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def sql(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, folder, sql, name):
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert rows
    check = entry.oracle_sql().get(name)
    if check is None:
        return
    cursor = sql.execute(check)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert ordered(rows) == ordered(expected)


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
