"""Every registered query of the plans against its SQL on DuckDB, at the smallest scale."""
from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from faremeter.plans import registry, sql_views
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
SQL = registry.ORACLES
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def check_plan(df):
    """No Python worker per row and no join without keys."""
    text = df._jdf.queryExecution().toString()
    for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF_DIR)
    check_plan(df)
    assert differences(df, duck, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(SQL)))
def test_without_sql_gives_rows(spark, name):
    df = registry.QUERIES[name](spark, SF_DIR)
    check_plan(df)
    assert df.count() > 0


@pytest.mark.parametrize("moves", ["moves", "moves_sweep"])
def test_the_last_round_of_the_sql_moves_nothing(duck, moves):
    """The SQL of the service queries is written out for so many rounds, which must be enough for these tables."""
    last = f"{moves}{sql_views.ROUNDS - 1}"
    assert duck.execute(sql_views.with_views(f"select count(*) from {last}", [last])).fetchone() == (0,)


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["pickupid", "dropoffid", "max", "min", "avg"]
    assert df.count() > 0


def test_entry_has_every_query():
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
