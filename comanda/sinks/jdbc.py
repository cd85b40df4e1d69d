"""JDBC sink of the serving store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from comanda.sources.jdbc import JdbcConfig


def write_options(config: JdbcConfig, table: str, truncate: bool = True, batch_size: int = 10_000) -> dict[str, str]:
    """``truncate`` empties the table on overwrite in place of dropping it, which keeps its grants and indexes."""
    return {
        "url": config.url,
        "dbtable": table,
        "driver": config.driver,
        "user": config.user,
        "password": config.password,
        "truncate": str(truncate).lower(),
        "batchsize": str(batch_size),
    }


def write_mart(df: DataFrame, config: JdbcConfig, table: str, mode: str = "overwrite") -> None:
    df.write.format("jdbc").options(**write_options(config, table)).mode(mode).save()
