"""Assignment of pending deliveries to couriers."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.geo import EARTH_RADIUS_KM, curve
from comanda.operators.keys import dense_key, ordered_key
from comanda.operators.paths import zone_distance
from comanda.session import cut_lineage

# Statuses that wait for dispatch, and the position of a courier without a known base zone.
PENDING = ["pending", "preparing", "delivering"]
DEFAULT_LAT, DEFAULT_LON = 14.60, -90.51
BATCH_SIZE = 60
LEGS = "batch long, order_id long, dest_zone string, customer string, total double, courier_id long, seq int, from_zone string"

# The group function travels to the workers as code, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def couriers_at_base(couriers: DataFrame, locations: DataFrame) -> DataFrame:
    base = locations.select(F.col("zone").alias("base_zone"), "lat", "lon")
    return couriers.join(base, "base_zone", "left").select(
        "courier_id", "name", "vehicle", "base_zone",
        F.coalesce("lat", F.lit(DEFAULT_LAT)).alias("base_lat"),
        F.coalesce("lon", F.lit(DEFAULT_LON)).alias("base_lon"),
    )


def waiting_orders(orders: DataFrame, placed: DataFrame, delivered_to: DataFrame, users: DataFrame, locations: DataFrame,
                   *also: str) -> DataFrame:
    """Orders that wait for dispatch, with their destination and customer, and further columns of the orders."""
    place = locations.select(F.col("zone").alias("dest_zone"), F.col("lat").alias("dest_lat"),
                             F.col("lon").alias("dest_lon"))
    return (
        orders.filter(F.col("status").isin(PENDING))
        .select("order_id", "total", *also)
        .join(delivered_to.select("order_id", F.col("zone").alias("dest_zone")), "order_id")
        .join(place, "dest_zone")
        .join(placed, "order_id")
        .join(users.select("user_id", F.col("name").alias("customer")), "user_id")
        .select("order_id", "dest_zone", "dest_lat", "dest_lon", "customer", "total", *also)
    )


def pending_orders(
    orders: DataFrame, placed: DataFrame, delivered_to: DataFrame, users: DataFrame, locations: DataFrame,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """All orders that wait for dispatch, in batches of ``batch_size`` by order id.

    One dispatch run takes one batch: batch 1 holds the oldest orders, the next run would take batch 2, and so on.
    """
    waiting = waiting_orders(orders, placed, delivered_to, users, locations)
    numbered = dense_key(cut_lineage(waiting), "order_id", "no")  # read twice: for the numbers and their offsets
    # A range of a dense number: integer arithmetic, at most batch_size rows per batch.
    batch = F.floor((F.col("no") - 1) / batch_size) + 1
    return numbered.withColumn("batch", batch.cast("bigint")).drop("no")


def _km(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle km from every first to every second position."""
    lat1, lon1, lat2, lon2 = (np.radians(np.asarray(x, dtype=float)) for x in (lat1, lon1, lat2, lon2))
    dlat, dlon = (lat2 - lat1[:, None]) / 2, (lon2 - lon1[:, None]) / 2
    chord = np.sin(dlat) ** 2 + np.cos(lat1)[:, None] * np.cos(lat2) * np.sin(dlon) ** 2
    return 2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(chord), np.sqrt(1 - chord))


def _dispatch(batch: pd.DataFrame, fleet: pd.DataFrame, fleet_size: int) -> pd.DataFrame:
    """Nearest neighbour inside one batch: each courier in turn takes the closest order left until its quota, which is
    that of a fleet of ``fleet_size``.

    Of equally near orders the one with the lowest id is taken.
    """
    batch = batch.sort_values("order_id", ignore_index=True)
    n = len(batch)
    quota = math.ceil(n / fleet_size)
    lat, lon = batch["dest_lat"].to_numpy(), batch["dest_lon"].to_numpy()
    used_fleet = fleet.iloc[: math.ceil(n / quota)]
    from_base = _km(used_fleet["base_lat"], used_fleet["base_lon"], lat, lon)
    from_order = _km(lat, lon, lat, lon)

    taken = np.zeros(n, dtype=bool)
    stops = []
    for turn in range(n):
        courier, seq = divmod(turn, quota)
        here = from_base[courier] if seq == 0 else from_order[stops[-1]]
        stops.append(int(np.where(taken, np.inf, here).argmin()))
        taken[stops[-1]] = True

    turns = np.arange(n)
    courier, seq = turns // quota, turns % quota
    out = batch.iloc[stops][["batch", "order_id", "dest_zone", "customer", "total"]].reset_index(drop=True)
    out["courier_id"] = used_fleet["courier_id"].to_numpy()[courier]
    out["seq"] = seq + 1
    out["from_zone"] = np.where(seq == 0, used_fleet["base_zone"].to_numpy()[courier], out["dest_zone"].shift())
    return out


def assign_stops(pending: DataFrame, couriers: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Each batch on its own: quota = orders / couriers rounded up, couriers in turn, then the nearest order each time.

    A full batch uses as many couriers as its quota leaves work for, and the next one starts with the courier after the
    last of them, so over the batches everybody gets work, whatever the size of the fleet. Only a batch's couriers meet its
    orders: no more than ``batch_size`` can get one.
    """
    fleet_size = couriers.count()
    if not fleet_size:
        return pending.sparkSession.createDataFrame([], LEGS)
    numbered = dense_key(couriers.select("courier_id", "base_zone", "base_lat", "base_lon"), "courier_id", "no")
    turns = min(fleet_size, batch_size)
    used = math.ceil(batch_size / math.ceil(batch_size / fleet_size))  # by a full batch
    first = (F.col("of_batch") - 1) * used
    slots = pending.select(F.col("batch").alias("of_batch")).distinct().withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    fleets = slots.withColumn("no", F.pmod(first + F.col("turn"), F.lit(fleet_size)) + 1).join(numbered, "no").drop("no")

    def dispatch(batch: pd.DataFrame, fleet: pd.DataFrame) -> pd.DataFrame:
        return _dispatch(batch, fleet.sort_values("turn", ignore_index=True), fleet_size)

    return pending.groupBy("batch").cogroup(fleets.groupBy("of_batch")).applyInPandas(dispatch, LEGS)


def batches_by_place(waiting: DataFrame, period: Column, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Orders with ``period``, ``batch`` (numbered through all periods) and ``part``, the batch's place among the ``parts`` of
    its period.

    The orders of a period are lined up along a curve that fills the map and cut into stretches of at most ``batch_size``:
    a batch is a neighbourhood, and a place with very many orders is several batches.
    """
    lined = waiting.withColumn("period", period).withColumn("_curve", curve(F.col("dest_lat"), F.col("dest_lon")))
    numbered = cut_lineage(ordered_key(lined, ["period", "_curve", "order_id"], "_no"))
    periods = numbered.groupBy("period").agg(F.min("_no").alias("_first"), F.count(F.lit(1)).alias("_orders")).withColumn(
        "parts", F.ceil(F.col("_orders") / batch_size).cast("bigint"))
    by_period = W.orderBy("period").rowsBetween(W.unboundedPreceding, -1)  # one row for each period
    periods = periods.select("period", "_first", "parts", F.coalesce(F.sum("parts").over(by_period), F.lit(0)).alias("_before"))
    part = F.floor((F.col("_no") - F.col("_first")) / batch_size).cast("bigint")
    return numbered.join(periods, "period").withColumn("part", part).withColumn(
        "batch", F.col("_before") + F.col("part") + 1).drop("_curve", "_no", "_first", "_before")


def assign_by_place(batched: DataFrame, couriers: DataFrame, network: DataFrame) -> DataFrame:
    """Stops as ``assign_routes`` gives them, for ``batches_by_place``.

    Couriers are lined up along the same curve by their base, and a period's batches take consecutive stretches of them: as
    many couriers for each batch, near it; with fewer couriers than batches, a courier serves several in turn.
    """
    lined = couriers.select("courier_id", "base_zone", "base_lat", "base_lon",
                            curve(F.col("base_lat"), F.col("base_lon")).alias("_curve"))
    lined = ordered_key(lined, ["_curve", "courier_id"], "no").drop("_curve")
    fleet_size = couriers.count()
    if not fleet_size:
        return batched.sparkSession.createDataFrame([], LEGS).withColumn("distance_km", F.lit(None).cast("double"))
    batches = batched.select(F.col("batch").alias("of_batch"), "part", "parts").distinct()
    first = F.expr(f"part * {fleet_size} div parts")
    last = F.greatest(F.expr(f"(part + 1) * {fleet_size} div parts"), first + 1)
    fleets = batches.withColumn("no", F.explode(F.sequence(first + 1, last))).join(lined, "no").drop("no", "part", "parts")

    def dispatch(batch: pd.DataFrame, fleet: pd.DataFrame) -> pd.DataFrame:
        return _dispatch(batch, fleet.sort_values("courier_id", ignore_index=True), len(fleet))

    chosen = batched.groupBy("batch").cogroup(fleets.groupBy("of_batch")).applyInPandas(dispatch, LEGS)
    return _with_distances(cut_lineage(chosen), network)


def assign_routes(
    pending: DataFrame, couriers: DataFrame, network: DataFrame, batch_size: int = BATCH_SIZE
) -> DataFrame:
    """The stops of ``assign_stops`` with the km of each leg over ``network`` (src, dst, km): stops are chosen by
    position, and only then paths are searched, from the zones where legs start."""
    return _with_distances(cut_lineage(assign_stops(pending, couriers, batch_size)), network)


def _with_distances(chosen: DataFrame, network: DataFrame) -> DataFrame:
    legs = chosen.select("from_zone", F.col("dest_zone").alias("to_zone"))
    km = zone_distance(legs, network).select("from_zone", F.col("to_zone").alias("dest_zone"), "distance_km")
    return chosen.join(km, ["from_zone", "dest_zone"], "left")


def route_summary(routes: DataFrame) -> DataFrame:
    """Orders and km of each courier, and the orders of the whole batch (a window over at most one batch)."""
    by_courier = routes.groupBy("batch", "courier_id").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("distance_km"), 2).alias("total_km")
    )
    return by_courier.withColumn("batch_orders", F.sum("orders").over(W.partitionBy("batch")))


def routes_nested(routes: DataFrame, couriers: DataFrame) -> DataFrame:
    """One record per batch and courier with the ordered list of stops; couriers without orders have none."""
    stop = F.struct("seq", "order_id", "dest_zone", "customer", "total", F.round("distance_km", 2).alias("distance_km"))
    stops = F.array_sort(F.collect_list(stop))
    per_courier = routes.groupBy("batch", "courier_id").agg(
        F.round(F.sum("distance_km"), 2).alias("total_distance_km"), stops.alias("stops")
    )
    return per_courier.join(couriers.select("courier_id", "name", "vehicle", "base_zone"), "courier_id").select(
        "batch", "courier_id", "name", "vehicle", "base_zone", "total_distance_km",
        F.transform("stops", lambda s: s.dropFields("seq")).alias("orders"),
    )
