"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tidewatch_checks.compare import compare, connect
from tidewatch_checks.registry import CHECKS

QUERIES = {name: run for name, run in entry.queries().items() if name in CHECKS}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    ok, text = compare(spark, duck, sf_dir, name, QUERIES[name], SQL.get(name))
    assert ok, text


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0]["feature"] == "l_quantity" and rows[0]["drifted"]
