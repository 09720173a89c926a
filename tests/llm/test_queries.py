"""The registered queries that SQL can express, against DuckDB at the smallest scale."""
from __future__ import annotations

from pathlib import Path

import pytest

from faremeter.llm import queries
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    con = connect(SF_DIR)
    try:
        assert differences(queries.QUERIES[name](spark, SF_DIR), con, queries.ORACLES[name]) == []
    finally:
        con.close()


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
