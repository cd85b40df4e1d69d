"""Tables in which one customer, one restaurant and one order hold a third of all rows.

Broadcast joins are off and the skew thresholds tiny, so that joins are shuffled and split as on large tables.
"""

from contextlib import contextmanager

import duckdb
import pytest
from pyspark.sql import functions as F

from comanda.operators.facts import FACT_ORDER_ITEMS
from comanda.plans.registry import all_queries, star
from oracles import all_oracles
from tests.conftest import SF_DIR
from tools.check_oracles import TABLES, compare

QUERIES, ORACLES = all_queries(), all_oracles()
NAMES = [
    "fact_orders", "fact_order_items", "items_per_order", "cube_revenue_month_category", "cube_orders_by_zone",
    "cube_product_ranking", "mart_monthly_growth", "mart_executive_summary", "graph_contains", "graph_recommends",
    "copurchase_top5", "influencers_degree", "influencers_pagerank", "recommendation_degrees", "recommendations_top5", "top3_per_category", "route_summary", "dq_referential",
]
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        df = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        if name == "orders":
            df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")))
        if name == "lineitem":
            hot = F.col("l_partkey") % 3 == 0
            df = df.withColumn("l_orderkey", F.when(hot, 6).otherwise(F.col("l_orderkey")))
            df = df.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 1, 4).otherwise(F.col("l_suppkey")))
        df.repartition(4).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def con(skewed):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{skewed}/{table}.parquet/*.parquet')")
    return con


@contextmanager
def settings(spark, partitions="8"):
    wanted = {**SETTINGS, "spark.sql.shuffle.partitions": partitions}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, skewed, con, name):
    with settings(spark):
        text, same, _ = compare(spark, con, skewed, name, QUERIES[name], ORACLES[name])
    assert same, text


@pytest.mark.parametrize("name", ["fact_orders", "cube_revenue_month_category", "graph_contains", "copurchase_top5"])
def test_one_partition(spark, skewed, con, name):
    with settings(spark, "1"):
        text, same, _ = compare(spark, con, skewed, name, QUERIES[name], ORACLES[name])
    assert same, text


def test_split_of_a_hot_partition(spark, skewed, con):
    """The join on the hot customer is split by the adaptive plan."""
    with settings(spark):
        df = star(spark, skewed).items(*FACT_ORDER_ITEMS[1:])
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
