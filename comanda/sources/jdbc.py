"""JDBC scan of the operational database."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcConfig:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10_000


def read_options(
    config: JdbcConfig,
    table: str | None = None,
    query: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """Reader options. ``partition`` = (column, lower, upper, partitions) reads through that many connections.

    Spark refuses a partition column together with ``query``, so a partitioned query goes in as a derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {
        "url": config.url,
        "user": config.user,
        "password": config.password,
        "driver": config.driver,
        "fetchsize": str(config.fetch_size),
    }
    if partition is None:
        options["dbtable" if table else "query"] = table or query
        return options
    column, lower, upper, count = partition
    options["dbtable"] = table or f"({query}) AS pushed"
    options |= {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(count),
    }
    return options


def read_jdbc(spark: SparkSession, config: JdbcConfig, **what) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(config, **what)).load()


def read_table_by_id(spark: SparkSession, config: JdbcConfig, table: str, connections: int = 1) -> DataFrame:
    """Whole table, split over ``connections`` by its integer ``id``; the bounds come from the database itself."""
    if connections <= 1:
        return read_jdbc(spark, config, table=table)
    bounds = read_jdbc(spark, config, query=f"SELECT min(id) AS lo, max(id) AS hi FROM {table}").first()
    if bounds is None or bounds["lo"] is None or bounds["lo"] == bounds["hi"]:
        return read_jdbc(spark, config, table=table)
    return read_jdbc(spark, config, table=table, partition=("id", bounds["lo"], bounds["hi"], connections))
