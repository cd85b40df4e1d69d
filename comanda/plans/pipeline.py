"""The batch run: extract, build, analyses side by side, export, quality gate."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from comanda.operators import catalog, cubes, dims, facts, marts, quality
from comanda.operators.cube_views import create_cube_views
from comanda.plans.star import LazyStar, StoredStar
from comanda.plans.dispatch import export_routes
from comanda.sinks.files import write_parquet
from comanda.sinks.jdbc import write_mart
from comanda.sinks.parts import PartStore
from comanda.sinks.tables import create_views, write_table
from comanda.sources.jdbc import JdbcConfig, read_jdbc, read_table_by_id
from comanda.sources.operational import OPERATIONAL_TABLES, staged_path, staged_tables

# Cube -> name of its export.
CUBE_EXPORTS = {
    "cube_revenue_month_category": "mart_revenue_by_cat",
    "cube_orders_by_zone": "mart_orders_by_zone",
    "cube_order_status": "mart_order_status",
    "cube_peak_hours": "mart_peak_hours_cube",
    "cube_product_ranking": "mart_product_ranking",
    "cube_courier_performance": "mart_courier_perf",
}


@dataclass(frozen=True)
class PipelineConfig:
    """``read_source(table)`` opens an operational table, ``write_serving(df, name)`` and ``read_serving(name)`` reach
    the serving store. The folders must be shared by all executors."""

    read_source: Callable[[str], DataFrame]
    write_serving: Callable[[DataFrame, str], object]
    read_serving: Callable[[str], DataFrame]
    staging_dir: str
    state_dir: str
    zones: DataFrame | None = None
    database: str = "order_dw"
    tables: list[str] = field(default_factory=lambda: list(OPERATIONAL_TABLES))
    min_orders: int = quality.MIN_ORDERS
    max_null_revenue: int = 1
    parallel_steps: int = 4


def jdbc_config(
    spark: SparkSession, source: JdbcConfig, serving: JdbcConfig, staging_dir: str, state_dir: str,
    connections: int = 8, **options,
) -> PipelineConfig:
    """Operational tables and serving store over JDBC; each table is read through several connections."""
    return PipelineConfig(
        read_source=lambda name: read_table_by_id(spark, source, name, connections),
        write_serving=lambda df, name: write_mart(df, serving, name),
        read_serving=lambda name: read_jdbc(spark, serving, table=name),
        staging_dir=staging_dir, state_dir=state_dir, **options,
    )


def extract(config: PipelineConfig) -> dict[str, int]:
    """Copy the operational tables to the staging folder; rows per table."""
    def copy(name: str) -> int:
        return write_parquet(config.read_source(name), staged_path(config.staging_dir, name))

    with ThreadPoolExecutor(config.parallel_steps) as pool:
        return dict(zip(config.tables, pool.map(copy, config.tables), strict=True))


def build_warehouse(spark: SparkSession, config: PipelineConfig) -> dict[str, int]:
    """Dimensions first; the facts look their keys up in the stored dimensions."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{config.database}`")
    tables = staged_tables(spark, config.staging_dir, config.zones)
    lazy, stored = LazyStar(spark, tables), StoredStar(spark, config.database)

    written = {"dim_category": write_table(lazy.dim_category, config.database, "dim_category")}
    plans = {
        "dim_date": lazy.dim_date,
        "dim_time": lazy.dim_time,
        "dim_product": dims.dim_product(tables.products, stored.dim_category),
        "dim_customer": lazy.dim_customer,
        "dim_restaurant": lazy.dim_restaurant,
        "dim_location": lazy.dim_location,
        "dim_courier": lazy.dim_courier,
    }
    written |= _write_all(plans, config)
    written |= _write_all({
        "fact_orders": facts.fact_orders(tables, stored),
        "fact_order_items": facts.fact_order_items(tables, stored),
    }, config)
    return written


def _write_all(plans: dict[str, DataFrame], config: PipelineConfig) -> dict[str, int]:
    """Independent tables in parallel: each write is its own Spark job."""
    def write(name: str) -> int:
        return write_table(plans[name], config.database, name)

    with ThreadPoolExecutor(config.parallel_steps) as pool:
        return dict(zip(plans, pool.map(write, plans), strict=True))


def register_cubes(spark: SparkSession, config: PipelineConfig) -> None:
    """The cubes as views of the catalogue, and under their bare names in this session."""
    create_cube_views(spark, config.database)
    star = StoredStar(spark, config.database)
    create_views({name: star.table(name) for name in cubes.CUBES})


def build_marts(spark: SparkSession, config: PipelineConfig) -> dict[str, int]:
    star = StoredStar(spark, config.database)
    return _write_all({name: build(star) for name, build in marts.MARTS.items()}, config)


def document_store(spark: SparkSession, config: PipelineConfig) -> PartStore:
    return PartStore(spark, f"{config.state_dir.rstrip('/')}/search_documents", "json")


def refresh_documents(spark: SparkSession, config: PipelineConfig) -> int:
    """Write the search documents of the id ranges that changed since the run before; how many ranges.

    Digests go into the same version as the documents, so a run that fails in between is repeated.
    """
    tables = staged_tables(spark, config.staging_dir, config.zones)
    return catalog.refresh(catalog.search_documents(tables.products, tables.categories), document_store(spark, config))


def exports(spark: SparkSession, config: PipelineConfig) -> dict[str, DataFrame]:
    """What goes to the serving store: stored marts, the cubes' views under their export names, the summary."""
    star = StoredStar(spark, config.database)
    out = {name: star.table(name) for name in marts.MARTS}
    out |= {CUBE_EXPORTS[name]: star.table(name) for name in cubes.CUBES}
    out["mart_executive_summary"] = marts.executive_summary(star)
    return out


def export_marts(spark: SparkSession, config: PipelineConfig) -> list[str]:
    frames = exports(spark, config)
    with ThreadPoolExecutor(config.parallel_steps) as pool:
        list(pool.map(lambda name: config.write_serving(frames[name], name), frames))
    return list(frames)


def dispatch_pending(spark: SparkSession, config: PipelineConfig) -> int:
    """The routes of the waiting orders as nested records; how many there are."""
    return export_routes(staged_tables(spark, config.staging_dir, config.zones), f"{config.state_dir.rstrip('/')}/routes")


def check_quality(config: PipelineConfig) -> DataFrame:
    """The report on the serving store; raises when a check failed."""
    names = [*quality.NOT_EMPTY, "mart_executive_summary"]
    report = quality.all_checks({name: config.read_serving(name) for name in names},
                                config.min_orders, config.max_null_revenue)
    quality.gate(report)
    return report


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> dict[str, object]:
    """All steps in order. The quality gate also runs after a failed step, and the first failure is raised."""
    result: dict[str, object] = {}
    failure: Exception | None = None
    try:
        result["extracted"] = extract(config)
        result["warehouse"] = build_warehouse(spark, config)
        register_cubes(spark, config)
        with ThreadPoolExecutor(2) as pool:
            documents = pool.submit(refresh_documents, spark, config)
            result["marts"] = build_marts(spark, config)
            result["documents_refreshed"] = documents.result()
        result["exported"] = export_marts(spark, config)
        result["routes"] = dispatch_pending(spark, config)
    except Exception as error:
        failure = error
    try:
        result["quality"] = check_quality(config)
    except Exception as error:
        failure = failure or error
    if failure:
        raise failure
    return result
