"""Every query with SQL against DuckDB, without regard to row order."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = entry.oracle_sql()


def plain(x):
    if isinstance(x, float):
        return round(x, 9)
    return str(x) if isinstance(x, datetime.datetime) else x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = entry.queries()[name](spark, SF)
    expected = db.execute(SQL[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(found.columns)
    assert rows(found.columns, found.collect()) == rows(names, expected.fetchall())
