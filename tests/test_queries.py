"""Every registered query against its oracle SQL in DuckDB on the smallest tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from starloom.workload.all_queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def norm(value):
    if isinstance(value, (float, Decimal)):
        value = float(value)
        return None if math.isnan(value) else float(f"{value:.10g}")
    return int(value) if isinstance(value, bool) else value


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    got = table(df.columns, df.collect())
    result = oracle.execute(ORACLE[name])
    want = table([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
