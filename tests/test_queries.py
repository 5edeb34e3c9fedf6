"""Every registered query against its SQL twin."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from conftest import SF_DIR

from curbflow.checks.queries import ORACLES, QUERIES


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.sql(f"create view {name} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    try:
        return float(value) + 0.0
    except (TypeError, ValueError):
        return value


def ordered(rows):
    return sorted((tuple(map(plain, row)) for row in rows), key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    listed = ", ".join(f'"{column}"' for column in columns)
    assert ordered(got.select(*columns).collect()) == ordered(want.select(listed).fetchall())
