"""The dispatch of waiting orders, from operational tables to a file of routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.operators import graph, routing
from comanda.session import cut_lineage
from comanda.sinks.files import write_json
from comanda.sources.operational import Tables


def network_of(direct: DataFrame) -> DataFrame:
    """Edges of the zone network."""
    return graph.routes_of(direct).select(
        F.col("from_zone").alias("src"), F.col("to_zone").alias("dst"), F.col("distance_km").alias("km")
    )


def pending(t: Tables) -> DataFrame:
    return routing.pending_orders(
        graph.orders(t), graph.placed(t), graph.delivered_to(t), graph.users(t), graph.locations(t)
    )


def fleet(t: Tables) -> DataFrame:
    return routing.couriers_at_base(graph.couriers(t), graph.locations(t))


def routes(t: Tables) -> DataFrame:
    return routing.assign_routes(pending(t), fleet(t), network_of(graph.direct_distances(cut_lineage(t.zones))))


def routes_by_place(t: Tables, period: str = "day", batch_size: int = routing.BATCH_SIZE) -> DataFrame:
    """Routes in batches by the period of the order and the neighbourhood of its destination."""
    orders = graph.orders(t).withColumn("ordered_at", F.to_timestamp("order_ts"))
    waiting = routing.waiting_orders(orders, graph.placed(t), graph.delivered_to(t), graph.users(t), graph.locations(t), "ordered_at")
    batched = cut_lineage(routing.batches_by_place(waiting, F.date_trunc(period, "ordered_at").cast("date"), batch_size))
    stops = routing.assign_by_place(batched, fleet(t), network_of(graph.direct_distances(cut_lineage(t.zones))))
    return stops.join(batched.select("order_id", "period"), "order_id").select("period", *stops.columns)


def export_routes(t: Tables, path: str) -> int:
    """One record per batch and courier with its stops in order; the number of records."""
    return write_json(routing.routes_nested(routes(t), fleet(t)), path)
