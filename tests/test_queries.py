"""Every registered query against its SQL, on the smallest data."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(clean(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, duck, name):
    result = entry_points.queries()[name](spark, FOLDER)
    sql = entry_points.oracle_sql().get(name)
    got = table(result.columns, result.collect())
    if sql is None:
        return
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert got == table(columns, cursor.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
