"""Warehouse tables and views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from comanda.schemas import WAREHOUSE


def create_warehouse(spark: SparkSession, database: str, location: str | None = None) -> None:
    """The database with its empty dimension and fact tables, as far as they do not exist."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` COMMENT 'order analytics warehouse'{place}")
    for table in WAREHOUSE.values():
        spark.sql(table.ddl(database))


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that runs along with the write, so no second run of the plan is needed."""
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def write_table(df: DataFrame, database: str, name: str, partitioned_by: Sequence[str] = ()) -> int:
    """Replace a table (ORC, Snappy) and return its row count. Writing twice leaves the same table.

    Rows of a partition are brought together before the write to avoid many small files; the rebalance lets AQE split a
    large partition over several tasks again.
    """
    table = WAREHOUSE.get(name)
    if table:
        df, partitioned_by = table.conform(df), table.partitioned_by
    if partitioned_by:
        df = df.hint("rebalance", *partitioned_by)
    df, rows = counted(df)
    writer = df.write.format("orc").option("compression", "snappy").mode("overwrite")
    if partitioned_by:
        writer = writer.partitionBy(*partitioned_by)
    writer.saveAsTable(f"{database}.{name}")
    if table:
        df.sparkSession.sql(f"COMMENT ON TABLE `{database}`.`{name}` IS '{table.comment}'")
    return rows.get["rows"]


def replace_partitions(df: DataFrame, database: str, name: str) -> int:
    """Reload only the partitions (months) that occur in ``df``; the others stay.

    An insert takes its overwrite mode from the session alone, not from a writer option, so the mode is switched for
    the time of the write. Do not overwrite other tables from the same session meanwhile.
    """
    table = WAREHOUSE[name]
    session = df.sparkSession
    stored = session.table(f"{database}.{name}").columns
    ordered, rows = counted(table.conform(df).select(*stored).hint("rebalance", *table.partitioned_by))
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = session.conf.get(mode)
    session.conf.set(mode, "dynamic")
    try:
        ordered.write.insertInto(f"{database}.{name}", overwrite=True)
    finally:
        session.conf.set(mode, before)
    return rows.get["rows"]


def drop_table(spark: SparkSession, database: str, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")


def create_views(views: dict[str, DataFrame]) -> None:
    """Session views, e.g. of the cubes, for use from SQL."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def preview(spark: SparkSession, database: str, name: str, rows: int = 10) -> DataFrame:
    """A few rows of a stored table."""
    return spark.table(f"{database}.{name}").limit(rows)
