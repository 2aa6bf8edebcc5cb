"""Every registered query against its SQL in DuckDB, on the driver's tables."""

import math
import os
import re
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows_by_column_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def same(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=0, abs_tol=1e-9)
    return type(left) is type(right) and left == right


def is_own(name):
    """Whether a query belongs to the analyses, not to the training-data operators."""
    return name != "pipeline" and not re.match(r"op\d+_", name)


def test_every_query_has_an_oracle():
    assert set(filter(is_own, queries())) == set(filter(is_own, oracle_sql()))


@pytest.mark.parametrize("name", list(filter(is_own, queries())))
def test_matches_oracle(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    found = rows_by_column_name(result.columns, result.collect())
    cursor = duck.execute(oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    expected = rows_by_column_name(columns, cursor.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert len(found) == len(expected) > 0
    for left, right in zip(found, expected):
        assert all(map(same, left, right)), (left, right)


def test_entry(spark):
    assert entry(spark).columns == ["division", "average_distance", "incidents_total"]
    assert entry(spark).count() > 0
