"""Graph files: one CSV folder per node label and relationship type, read with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the graph files.
GRAPH_FILES = {
    "users": "user_id long, name string, email string, role string, zone string, lat double, lon double",
    "restaurants": "rest_id long, name string, address string, zone string, lat double, lon double, rating double",
    "products": "prod_id long, name string, price double, available boolean, category string",
    "couriers": "courier_id long, name string, vehicle string, base_zone string",
    "locations": "zone string, zone_name string, lat double, lon double",
    "orders": "order_id long, user_id long, rest_id long, status string, total double, payment_method string, "
              "order_ts string",
    "order_items": "order_id long, prod_id long, quantity int, unit_price double, line_total double",
    "deliveries": "order_id long, courier_id long, dest_zone string, distance_km double, eta_min double, "
                  "status string",
    "user_recommendations": "user_id long, via_restaurant long, recommended_by long, recommends long",
    "zone_routes": "from_zone string, to_zone string, distance_km double, time_min double",
}


def read_graph_file(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An empty field is NULL; a field that is not of its type fails the read, so no row is lost silently."""
    reader = spark.read.schema(GRAPH_FILES[name]).option("header", True).option("mode", "FAILFAST")
    return reader.option("nullValue", "").csv(f"{folder.rstrip('/')}/{name}")


def to_typed(raw: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Columns of text as their types; an empty or malformed value becomes NULL."""
    return raw.select(*[F.col(c).try_cast(t).alias(c) for c, t in schema.items()])
