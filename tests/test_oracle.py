"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import plan
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def _normal(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_normal(record[i]) for i in order) for record in records), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    expected = duck.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.collect(), df.columns) == _sorted(expected.fetchall(), columns)
    text = plan(df)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert ("EvalPython" in text) == (name == "config_changeset")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
