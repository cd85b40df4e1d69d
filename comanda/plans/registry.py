"""Named queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators import basket, boards, catalog, cubes, facts, graph, influence, marts, paths, quality, recommend, routing
from comanda.plans import dispatch
from comanda.plans.star import LazyStar
from comanda.session import cut_lineage
from comanda.sources.operational import Tables
from comanda.sources.testdata import operational_tables

Query = Callable[[SparkSession, str], DataFrame]


def star(spark: SparkSession, sf_dir: str) -> LazyStar:
    return LazyStar(spark, operational_tables(spark, sf_dir))


def _on_star(function) -> Query:
    return lambda spark, sf_dir: function(star(spark, sf_dir))


def _board(cube: str, function) -> Query:
    return lambda spark, sf_dir: function(cubes.CUBES[cube](star(spark, sf_dir)))


def warehouse_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "dim_date": _on_star(lambda s: s.dim_date),
        "dim_category": _on_star(lambda s: s.dim_category),
        "dim_product": _on_star(lambda s: s.dim_product),
        "dim_customer": _on_star(lambda s: s.dim_customer),
        "dim_restaurant": _on_star(lambda s: s.dim_restaurant),
        "dim_location": _on_star(lambda s: s.dim_location),
        "dim_courier": _on_star(lambda s: s.dim_courier),
        "items_per_order": _on_star(lambda s: facts.items_per_order(s.tables.order_items)),
        "fact_orders": _on_star(lambda s: s.orders()),
        "fact_order_items": _on_star(lambda s: s.items()),
    }
    out |= {name: _on_star(function) for name, function in cubes.CUBES.items()}
    out |= {name: _on_star(function) for name, function in marts.MARTS.items()}
    out["mart_executive_summary"] = _on_star(marts.executive_summary)
    out["busiest_hours"] = _on_star(lambda s: marts.busiest_hours(marts.peak_hours_ranked(s)))
    out |= {name: _board(cube, function) for name, (cube, function) in boards.BOARDS.items()}
    return out




def _last_line() -> Column:
    """The test tables have no line id: the last of repeated lines is the one with the largest amount, then quantity,
    then price."""
    return F.struct("line_total", "quantity", "unit_price")


def _on_tables(function) -> Query:
    return lambda spark, sf_dir: function(operational_tables(spark, sf_dir))


def _edges(t: Tables) -> DataFrame:
    return graph.contains(t, _last_line())


def zone_distances(zones: DataFrame) -> DataFrame:
    """All pairs of zones: the network has an edge between every two, by definition."""
    zones = cut_lineage(zones)
    direct = cut_lineage(graph.direct_distances(zones))
    pairs = direct.select("from_zone", "to_zone").unionByName(
        zones.select(F.col("zone").alias("from_zone"), F.col("zone").alias("to_zone")))
    return paths.zone_distance(pairs, dispatch.network_of(direct))


def flat_path(route: DataFrame, km_list: str, km: str) -> DataFrame:
    """A path with its lists as text."""
    two_digits = F.transform(km_list, lambda x: F.format_string("%.2f", x))
    return route.select(
        F.array_join("route", ">").alias("route"),
        F.array_join(two_digits, ">").alias(km_list),
        F.round(km, 2).alias("total_km"),
    )


# The two zones whose connection is asked for: from the first to the second.
HOPS_BETWEEN = ("NATION_1", "NATION_7")
KM_BETWEEN = ("NATION_1", "NATION_13")
# In the sparse network: edges of at most so many km, and the ends of a way with many hops.
NEIGHBOUR_KM = 6.5
FAR_BETWEEN = ("NATION_7", "NATION_9")


def _shortest_hops(t: Tables) -> DataFrame:
    network = dispatch.network_of(graph.direct_distances(cut_lineage(t.zones)))
    return flat_path(paths.fewest_hops(network, *HOPS_BETWEEN), "legs_km", "total_km")


def _shortest_weighted(t: Tables) -> DataFrame:
    network = dispatch.network_of(graph.direct_distances(cut_lineage(t.zones)))
    return flat_path(paths.lightest_path(network, *KM_BETWEEN), "costs", "km")


def _neighbours(t: Tables) -> DataFrame:
    """The zone network without its long edges: ways lead over the zones in between."""
    return dispatch.network_of(graph.direct_distances(cut_lineage(t.zones))).filter(F.col("km") <= NEIGHBOUR_KM)


def graph_queries() -> dict[str, Query]:
    out = {f"graph_{name}": _on_tables(function) for name, function in {
        "users": graph.users, "restaurants": graph.restaurants, "products": graph.products,
        "couriers": graph.couriers, "locations": graph.locations, "orders": graph.orders,
        "placed": graph.placed, "from_restaurant": graph.from_restaurant, "contains": _edges,
        "delivered_to": graph.delivered_to, "assigned": graph.assigned, "recommends": graph.recommendations,
    }.items()}
    out["graph_label_counts"] = _on_tables(
        lambda t: graph.label_counts({label: nodes(t) for label, nodes in graph.NODES.items()}))
    out["zone_routes"] = _on_tables(lambda t: graph.zone_routes(t.zones))
    out["copurchase_top5"] = _on_tables(lambda t: basket.copurchase(graph.lines_between(t), graph.products(t)))
    out["recommendation_degrees"] = _on_tables(lambda t: recommend.degrees(graph.visits(t)))
    out["recommendations_top5"] = _on_tables(lambda t: recommend.top_recommendations(graph.visits(t)))
    out["influencers_degree"] = _on_tables(lambda t: influence.degree(graph.visits(t), graph.users(t)))
    out["influencers_pagerank"] = _on_tables(lambda t: influence.top_pagerank(graph.recommendations(t), graph.users(t)))
    out["shortest_hops"] = _on_tables(_shortest_hops)
    out["shortest_weighted"] = _on_tables(_shortest_weighted)
    out["far_hops"] = _on_tables(lambda t: flat_path(paths.fewest_hops(_neighbours(t), *FAR_BETWEEN), "legs_km", "total_km"))
    out["far_weighted"] = _on_tables(lambda t: flat_path(paths.lightest_path(_neighbours(t), *FAR_BETWEEN), "costs", "km"))
    out["top3_per_category"] = _on_tables(lambda t: basket.top_products(_edges(t), graph.products(t)))
    out["courier_top_zone"] = _on_tables(
        lambda t: basket.courier_top_zone(graph.zones_of_couriers(t), graph.couriers(t)))
    return out


def routing_queries() -> dict[str, Query]:
    return {
        "routing_couriers": _on_tables(dispatch.fleet),
        "routing_pending": _on_tables(dispatch.pending),
        "zone_distance": _on_tables(lambda t: zone_distances(t.zones)),
        "route_assignment": _on_tables(dispatch.routes),
        "route_by_place": _on_tables(lambda t: dispatch.routes_by_place(t, "month", 12)),
        "route_summary": _on_tables(lambda t: routing.route_summary(dispatch.routes(t))),
    }


def _as_text(digests: DataFrame) -> DataFrame:
    return digests.select("id_range", "documents", F.concat_ws("|", F.col("head").cast("string"), F.col("tail").cast("string")).alias("digest"))


def quality_queries() -> dict[str, Query]:
    return {
        "dq_row_counts": _on_star(lambda s: quality.report(
            quality.row_count_checks({name: build(s) for name, build in marts.MARTS.items()}))),
        "dq_min_orders": _on_star(lambda s: quality.report([quality.min_orders_check(marts.executive_summary(s))])),
        "dq_null_revenue": _on_star(lambda s: quality.report([quality.null_revenue_check(marts.trends(s))])),
        "dq_referential": _on_tables(quality.referential),
        "catalog_fingerprint": _on_tables(lambda t: catalog.fingerprint(t.products)),
        "catalog_range_digests": _on_tables(lambda t: _as_text(
            catalog.range_digests(catalog.search_documents(t.products, t.categories), bits=6))),
        "search_documents": _on_tables(lambda t: catalog.search_documents(t.products, t.categories)),
        "orders_per_status": _on_tables(lambda t: quality.orders_per_status(t.orders)),
        "orders_per_month": _on_tables(lambda t: quality.orders_per_month(t.orders)),
    }


def all_queries() -> dict[str, Query]:
    return {**warehouse_queries(), **graph_queries(), **routing_queries(), **quality_queries()}
