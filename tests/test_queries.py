"""Every registered query against its SQL on the smallest tables, and its plan."""

import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from comanda.plans.registry import all_queries
from oracles import all_oracles
from tests.conftest import SF_DIR
from tools.check_oracles import TABLES, compare

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    text, same, df = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert same and "type of" not in text, text
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_scans_read_only_their_columns(spark):
    plan = plan_of(QUERIES["cube_order_status"](spark, SF_DIR))
    assert "lineitem" not in plan  # restaurant lookup is not needed, so its scan is gone
    assert "o_custkey" not in plan and "o_orderpriority" not in plan


def test_group_limits_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["top3_per_category"](spark, SF_DIR))


@pytest.mark.parametrize(("name", "most"), [
    ("mart_executive_summary", {"orders": 1, "customer": 1, "supplier": 1}),
    ("mart_monthly_growth", {"customer": 1}),
    ("courier_top_zone", {"orders": 3, "customer": 3}),
    ("fact_orders", {"orders": 3, "customer": 3, "supplier": 2}),  # deliveries and couriers are made from orders
    ("cube_product_ranking", {"part": 3, "orders": 1, "lineitem": 2}),
])
def test_tables_are_not_read_again(spark, name, most):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    plan = plan_of(df).split("== Initial Plan ==")[0]
    for table, times in most.items():
        assert len(re.findall(rf"InMemoryFileIndex[^\n]*/{table}\.parquet", plan)) <= times, (table, plan)


def test_rows_made_for_recommendations(spark):
    """One row for each visit, not for each pair of visitors."""
    visits = QUERIES["graph_recommends"](spark, SF_DIR)
    assert visits.count() <= spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
