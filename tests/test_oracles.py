"""Every registered query against its SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

from tests.conftest import SMALL
from tests.oracle import differences
from tripflow.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(SMALL)):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SMALL}/{file}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    found = QUERIES[name](spark, SMALL).toPandas()
    assert differences(found, duck.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.queries().keys() >= QUERIES.keys()
    assert entry.oracle_sql().keys() >= ORACLES.keys()
