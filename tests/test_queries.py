"""Every registered query against its SQL on the given tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("missing", ["shelfwise.llm", "shelfwise.llm.queries", "xxhash", "corpus_pipeline"])
def test_other_queries_stay_without_the_training_data_operators(monkeypatch, missing):
    """They, their pipeline or a package that they need cannot be imported."""
    for name in [n for n in sys.modules if n.split(".")[0] == "corpus_pipeline" or n.startswith("shelfwise.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())
    assert "pipeline" not in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 166


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sql, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = sql.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = _rows(result.columns, [tuple(row) for row in result.collect()])
    assert got == _rows(columns, expected.fetchall())


def test_known_totals_at_sf001(spark):
    """Counts and sums computed beforehand, apart from the registered SQL."""
    run = contract.queries()
    larger = "/root/testdata/sf0.01"

    def totals(name, *expressions):
        return tuple(run[name](spark, larger).selectExpr(*expressions).first())

    assert totals("silver_sales_events", "count(*)") == (1981,)
    assert totals("silver_inventory_events", "count(*)") == (1982,)
    assert totals("fact_sales_daily", "count(*)", "sum(total_qty_sold)", "sum(sales_event_count)") == (
        445,
        4979,
        1981,
    )
    assert totals("fact_inventory_daily", "count(*)", "sum(on_hand_latest)") == (441, 4313)
    assert totals(
        "features_daily", "count(*)", "count(on_hand_latest)", "sum(stockout_risk_label)"
    ) == (445, 436, 64)
    assert totals("lineitem_sales_daily", "count(*)", "sum(total_qty_sold)") == (59996, 1524135)
    assert totals("orders_latest_per_customer", "count(*)", "sum(o_orderkey)") == (1500, 11030055)
