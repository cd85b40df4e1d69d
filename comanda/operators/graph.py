"""Property graph of orders: one DataFrame for each node label and each relationship type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.geo import haversine_km
from comanda.operators.keys import dense_key, running_sum
from comanda.sources.operational import GRAPH_ZONE_NAMES, Tables

SPEED_KM_PER_HOUR = 30


# ---- nodes -----------------------------------------------------------------------------------------------

def users(t: Tables) -> DataFrame:
    return t.users.select(F.col("id").alias("user_id"), "name", "email", "role", "zone", "lat", "lon")


def restaurants(t: Tables) -> DataFrame:
    return t.restaurants.select(F.col("id").alias("rest_id"), "name", "address", "zone", "lat", "lon", "rating")


def products(t: Tables) -> DataFrame:
    category = t.categories.select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    return t.products.join(category, "category_id").select(
        F.col("id").alias("prod_id"), "name", F.col("price").cast("double").alias("price"), "available", "category"
    )


def couriers(t: Tables) -> DataFrame:
    return t.couriers.select(F.col("id").alias("courier_id"), "name", "vehicle", "base_zone")


def locations(t: Tables) -> DataFrame:
    """Zones under the names that the graph has for them."""
    name = F.col("zone_name")
    for short, long in GRAPH_ZONE_NAMES.items():
        name = F.when(F.col("zone_name") == short, long).otherwise(name)
    return t.zones.select("zone", name.alias("zone_name"), "lat", "lon")


def orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("id").alias("order_id"),
        "status",
        F.col("total").cast("double").alias("total"),
        "payment_method",
        F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss").alias("order_ts"),
    )


NODES = {
    "User": users,
    "Restaurant": restaurants,
    "Product": products,
    "Courier": couriers,
    "Location": locations,
    "Order": orders,
}


def label_counts(nodes: dict[str, DataFrame]) -> DataFrame:
    """Nodes of each label, most frequent first. Each label is counted on its own; no rows are moved."""
    counts = [df.agg(F.count(F.lit(1)).alias("nodes")).select(F.lit(label).alias("label"), "nodes")
              for label, df in nodes.items()]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("nodes"), "label")


# ---- relationships: both end nodes must exist, and a pair has one edge ------------------------------------

def _ids(nodes: DataFrame, name: str, key: str = "id") -> DataFrame:
    return nodes.select(F.col(key).alias(name))


def placed(t: Tables) -> DataFrame:
    """User -> Order. The order id is the key of its table, so the pairs are distinct already."""
    pairs = t.orders.select("user_id", F.col("id").alias("order_id"))
    return pairs.join(_ids(t.users, "user_id"), "user_id", "left_semi").select("user_id", "order_id")


def from_restaurant(t: Tables) -> DataFrame:
    pairs = t.orders.select(F.col("id").alias("order_id"), F.col("restaurant_id").alias("rest_id"))
    return pairs.join(_ids(t.restaurants, "rest_id"), "rest_id", "left_semi").select("order_id", "rest_id")


def lines_between(t: Tables) -> DataFrame:
    """(order_id, prod_id) of every line whose order and product exist; a product repeated in an order is repeated."""
    ends = t.order_items.select("order_id", F.col("product_id").alias("prod_id"))
    return ends.join(_ids(t.orders, "order_id"), "order_id", "left_semi").join(
        _ids(products(t), "prod_id", "prod_id"), "prod_id", "left_semi"
    )


def contains(t: Tables, last_by: Column | None = None) -> DataFrame:
    """Order -> Product. A product repeated in an order has one edge, with the values of its last line.

    ``last_by`` tells which line is the last, by default the line id (a number keeps the aggregation in hash tables; a
    struct of columns is right for any values). Lines are reduced before the shuffle, so a product or an order with very
    many lines does not end up in one task.
    """
    place = F.col("id") if last_by is None else last_by
    last = [F.max_by(c, place).alias(c) for c in ("quantity", "unit_price", "line_total")]
    edges = t.order_items.groupBy("order_id", F.col("product_id").alias("prod_id")).agg(*last)
    return (
        edges.join(_ids(t.orders, "order_id"), "order_id", "left_semi")
        .join(_ids(products(t), "prod_id", "prod_id"), "prod_id", "left_semi")
        .select("order_id", "prod_id", "quantity", "unit_price", "line_total")
    )


def delivered_to(t: Tables) -> DataFrame:
    """Order -> Location, with distance, ETA and the order's status."""
    status = t.orders.select(F.col("id").alias("order_id"), "status")
    return (
        t.deliveries.select("order_id", F.col("dest_zone").alias("zone"), "distance_km", "eta_min")
        .join(status, "order_id")
        .join(_ids(t.zones, "zone", "zone"), "zone", "left_semi")
        .select("order_id", "zone", F.col("distance_km").cast("double").alias("distance_km"),
                F.col("eta_min").cast("double").alias("eta_min"), "status")
    )


def assigned(t: Tables) -> DataFrame:
    """Courier -> Order, for deliveries that have a courier."""
    return (
        t.deliveries.filter(F.col("courier_id").isNotNull())
        .select("courier_id", "order_id")
        .join(_ids(t.couriers, "courier_id"), "courier_id", "left_semi")
        .join(_ids(t.orders, "order_id"), "order_id", "left_semi")
    )


def visits(t: Tables) -> DataFrame:
    """(user_id, via_restaurant): who ordered where, each pair once."""
    return (
        t.orders.filter(F.col("user_id").isNotNull() & F.col("restaurant_id").isNotNull())
        .select("user_id", F.col("restaurant_id").alias("via_restaurant"))
        .distinct()
    )


def zones_of_couriers(t: Tables) -> DataFrame:
    """(courier_id, order_id, zone) of the deliveries whose courier, order and zone exist, in one pass over them."""
    return (
        t.deliveries.filter(F.col("courier_id").isNotNull())
        .select("courier_id", "order_id", F.col("dest_zone").alias("zone"))
        .join(_ids(t.couriers, "courier_id"), "courier_id", "left_semi")
        .join(_ids(t.zones, "zone", "zone"), "zone", "left_semi")
        .join(_ids(t.orders, "order_id"), "order_id", "left_semi")
    )


def recommendations(t: Tables) -> DataFrame:
    """User -> User over a shared restaurant, one row for each visit instead of one for each pair.

    Of two users of a restaurant the one with the smaller id recommends the other. So a visit stands for edges from the
    ``recommended_by`` visitors with smaller ids, and to the ``recommends`` ones with larger ids; the pairs themselves,
    whose number grows with the square of the visitors, are never listed.
    """
    numbered = running_sum(visits(t).withColumn("_one", F.lit(1).cast("bigint")), "via_restaurant", "user_id", "_one",
                           "recommended_by", "_all")
    return numbered.select("user_id", "via_restaurant", "recommended_by",
                           (F.col("_all") - F.col("recommended_by") - 1).alias("recommends"))


def first_recommendations(t: Tables, max_edges: int) -> DataFrame:
    """The first ``max_edges`` pairs (from_user, to_user, via_restaurant) by (to, from, via), for a listing of that length.

    Call the n-th user of a restaurant, by user id, its place n; it has an edge from each of the n-1 before. The wanted
    edges end at the ``max_edges`` smallest (user, restaurant) visits with a predecessor, and those are at the first
    ``max_edges`` + 1 places of their restaurants; everybody before them is at such a place, too. Spark cuts each
    restaurant to these places before the shuffle (while they are within its window group limit of 1000).
    """
    by_user = W.partitionBy("via_restaurant").orderBy("user_id")
    first = visits(t).withColumn("place", F.row_number().over(by_user)).filter(F.col("place") <= max_edges + 1)

    with_predecessor = first.filter(F.col("place") > 1)
    last_end = with_predecessor.select("user_id").orderBy("user_id").limit(max_edges).agg(F.max("user_id"))
    end = with_predecessor.filter(F.col("user_id") <= last_end.scalar()).select(
        F.col("user_id").alias("to_user"), "via_restaurant"
    )
    start = first.select(F.col("user_id").alias("from_user"), "via_restaurant")
    return (
        start.join(end, "via_restaurant")
        .filter(F.col("from_user") < F.col("to_user"))
        .select("from_user", "to_user", "via_restaurant")
        .orderBy("to_user", "from_user", "via_restaurant")
        .limit(max_edges)
    )


def _zone_pairs(zones: DataFrame) -> DataFrame:
    """Every unordered pair of zones with its great-circle km.

    Each zone lists the numbers of the zones after it and looks them up: an equi-join in place of a theta join.
    """
    numbered = dense_key(zones.select("location_key", "zone", "lat", "lon"), "location_key", "no")
    size = zones.agg(F.count(F.lit(1)))
    one = numbered.filter(F.col("no") < size.scalar()).select(
        F.col("zone").alias("from_zone"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"),
        F.explode(F.sequence(F.col("no") + 1, size.scalar())).alias("no"),
    )
    other = numbered.select("no", F.col("zone").alias("to_zone"), F.col("lat").alias("lat2"),
                            F.col("lon").alias("lon2"))
    km = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return one.join(other, "no").select("from_zone", "to_zone", km.alias("km"))


def _both_ways(pairs: DataFrame) -> DataFrame:
    swapped = {"from_zone": "to_zone", "to_zone": "from_zone"}
    return pairs.unionByName(pairs.select(*[F.col(swapped.get(c, c)).alias(c) for c in pairs.columns]))


def direct_distances(zones: DataFrame) -> DataFrame:
    """Unrounded great-circle km between every two zones, in both directions."""
    return _both_ways(_zone_pairs(zones))


def routes_of(direct: DataFrame) -> DataFrame:
    """The zone network of direct distances: rounded km, and minutes at 30 km/h."""
    rounded = direct.select("from_zone", "to_zone", F.round("km", 2).alias("distance_km"))
    return rounded.withColumn("time_min", F.round(F.col("distance_km") / SPEED_KM_PER_HOUR * 60, 1))


def zone_routes(zones: DataFrame) -> DataFrame:
    return routes_of(direct_distances(zones))


# ---- upsert ------------------------------------------------------------------------------------------------

def upsert(existing: DataFrame, updates: DataFrame, keys: list[str], last_by: list[str]) -> DataFrame:
    """Edges or nodes after a merge: updates replace rows with the same keys; of repeated updates the last counts."""
    values = [c for c in updates.columns if c not in keys]
    last = F.max(F.struct(*last_by, *[c for c in values if c not in last_by])).alias("last")
    latest = updates.groupBy(*keys).agg(last).select(*keys, *[f"last.{c}" for c in values])
    return existing.join(latest, keys, "left_anti").unionByName(latest.select(*existing.columns))
