"""Graph extracts written as files, and the graph read back from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators import graph
from comanda.sinks.files import write_csv
from comanda.sinks.parts import PartStore
from comanda.sources.graph_csv import GRAPH_FILES, read_graph_file
from comanda.sources.operational import Tables

# What makes a row of a file the same node or edge.
MERGE_KEYS = {
    "users": ["user_id"], "restaurants": ["rest_id"], "products": ["prod_id"], "couriers": ["courier_id"],
    "locations": ["zone"], "orders": ["order_id"], "order_items": ["order_id", "prod_id"], "deliveries": ["order_id"],
    "user_recommendations": ["user_id", "via_restaurant"], "zone_routes": ["from_zone", "to_zone"],
}


def extracts(t: Tables) -> dict[str, DataFrame]:
    """The ten files of the graph. Orders, lines and deliveries carry the ends of several relationship types.

    Recommendations are all there, as visits: a user of a restaurant recommends its users with larger ids.
    """
    orders = t.orders.select(
        F.col("id").alias("order_id"), "user_id", F.col("restaurant_id").alias("rest_id"), "status",
        F.col("total").cast("double").alias("total"), "payment_method",
        F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss").alias("order_ts"),
    )
    lines = t.order_items.select("order_id", F.col("product_id").alias("prod_id"), "quantity", "unit_price",
                                 "line_total")
    status = t.orders.select(F.col("id").alias("order_id"), "status")
    deliveries = t.deliveries.join(status, "order_id").select(
        "order_id", "courier_id", "dest_zone", "distance_km", F.col("eta_min").cast("double").alias("eta_min"), "status"
    )
    return {
        "users": graph.users(t),
        "restaurants": graph.restaurants(t),
        "products": graph.products(t),
        "couriers": graph.couriers(t),
        "locations": graph.locations(t),
        "orders": orders,
        "order_items": lines,
        "deliveries": deliveries,
        "user_recommendations": graph.recommendations(t),
        "zone_routes": graph.zone_routes(t.zones),
    }


def export_graph(t: Tables, folder: str) -> dict[str, int]:
    """Replace all graph files; rows per file."""
    return {name: write_csv(df, f"{folder.rstrip('/')}/{name}") for name, df in extracts(t).items()}


def load_graph(spark: SparkSession, folder: str, existing: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The graph after its files are merged into it: rows of the files replace those with the same keys.

    Lines that repeat a key in a file are merged as well. Files have no order once they are read in parallel: of such
    lines the one with the largest values counts.
    """
    def merged(name: str) -> DataFrame:
        updates = read_graph_file(spark, folder, name)
        before = (existing or {}).get(name)
        keys = MERGE_KEYS[name]
        return graph.upsert(before if before is not None else spark.createDataFrame([], updates.schema), updates, keys,
                            [c for c in updates.columns if c not in keys])

    return {name: merged(name) for name in GRAPH_FILES}


GRAPH_PARTS = 64  # of each stored table


def stored_graph(spark: SparkSession, store: str, parts: int = GRAPH_PARTS) -> dict[str, PartStore]:
    """The stored tables of the graph, by the name of their file."""
    return {name: PartStore(spark, f"{store.rstrip('/')}/{name}", parts=parts) for name in GRAPH_FILES}


def merge_graph(spark: SparkSession, folder: str, store: str, parts: int = GRAPH_PARTS) -> dict[str, list[int]]:
    """Merge the graph's files into its stored tables, as ``load_graph`` does; the parts of each table that were rewritten."""
    def merged(name: str, table: PartStore) -> list[int]:
        updates, keys = read_graph_file(spark, folder, name), MERGE_KEYS[name]
        return table.merge(updates, keys, [c for c in updates.columns if c not in keys])

    return {name: merged(name, table) for name, table in stored_graph(spark, store, parts).items()}
