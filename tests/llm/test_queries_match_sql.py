"""Queries that SQL can express, over the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tidewatch.llm import queries
from tidewatch_checks.compare import compare, connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, sf_dir, name):
    con = connect(sf_dir)
    ok, text = compare(spark, con, sf_dir, name, entry.queries()[name], entry.oracle_sql()[name])
    con.close()
    assert ok, text


def test_one_query_per_operator():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n[:2] == "op" and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
