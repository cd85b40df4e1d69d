"""The set of operational tables that the warehouse and the graph are built from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Operational tables in extraction order.
OPERATIONAL_TABLES = [
    "categories", "restaurants", "products", "menus", "menu_products",
    "users", "couriers", "orders", "order_items", "deliveries",
]


# The delivery zones with their centres.
ZONES = [
    (1, "zona_1", "Zona 1", 14.6407, -90.5133),
    (2, "zona_4", "Zona 4", 14.6257, -90.5218),
    (3, "zona_9", "Zona 9", 14.6032, -90.5172),
    (4, "zona_10", "Zona 10", 14.5994, -90.5069),
    (5, "zona_11", "Zona 11", 14.6050, -90.5333),
    (6, "zona_13", "Zona 13", 14.5775, -90.5283),
    (7, "antigua", "Antigua", 14.5586, -90.7295),
]


# Fixed value: the one zone that the graph names differently.
GRAPH_ZONE_NAMES = {"Antigua": "Antigua Guatemala"}


def default_zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ZONES, "location_key int, zone string, zone_name string, lat double, lon double")


@dataclass(frozen=True)
class Tables:
    categories: DataFrame
    restaurants: DataFrame
    products: DataFrame
    users: DataFrame
    couriers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    deliveries: DataFrame
    zones: DataFrame
    line_order: tuple[str, ...] = ("id",)  # what the keys of lines follow


def staged_path(staging_dir: str, table: str) -> str:
    return f"{staging_dir.rstrip('/')}/{table}.parquet"


def read_staged(spark: SparkSession, staging_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(staged_path(staging_dir, table))


def staged_tables(spark: SparkSession, staging_dir: str, zones: DataFrame | None = None) -> Tables:
    """Tables from a staging folder; ``zones`` defaults to the fixed catalogue."""
    names = ["categories", "restaurants", "products", "users", "couriers", "orders", "order_items", "deliveries"]
    frames = {name: read_staged(spark, staging_dir, name) for name in names}
    return Tables(**frames, zones=zones if zones is not None else default_zones(spark))
