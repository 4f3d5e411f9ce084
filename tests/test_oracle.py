"""Every registered query with SQL gives the same rows as that SQL on the same tables."""

import datetime
import os

import duckdb
import pytest

from obsforge.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not available")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    return str(value) if isinstance(value, datetime.datetime) else repr(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    relation = database.sql(SQL[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    expected = sorted(tuple(plain(r[i]) for i in places) for r in relation.fetchall())
    actual = sorted(tuple(plain(r[c]) for c in columns) for r in result.collect())
    assert actual == expected


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_inventory_is_covered():
    ids = {name.split("_")[0] for name in QUERIES}
    sizes = {"S": 8, "P": 11, "N": 5, "E": 6, "O": 5, "G": 10, "H": 2, "I": 6, "V": 6, "M": 5, "L": 11, "R": 7, "W": 7}
    assert ids == {f"{letter}{i}" for letter, n in sizes.items() for i in range(1, n + 1)}
