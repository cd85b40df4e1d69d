import math

import pytest
from pyspark.sql import functions as F

from comanda.operators import graph, paths, routing
from comanda.sinks.files import write_json
from comanda.sources.operational import ZONES, default_zones
from tests.golden_routes import ROUTES


@pytest.fixture(scope="module")
def zones(spark):
    return default_zones(spark)


@pytest.fixture(scope="module")
def network(zones):
    return graph.zone_routes(zones).selectExpr("from_zone src", "to_zone dst", "distance_km km")


@pytest.fixture(scope="module")
def distances(zones, network):
    pairs = network.selectExpr("src from_zone", "dst to_zone").union(zones.selectExpr("zone", "zone"))
    return paths.zone_distance(pairs, network)


def test_zone_network(zones, distances):
    edges = {(r.from_zone, r.to_zone): r for r in graph.zone_routes(zones).collect()}
    assert len(edges) == 42
    assert edges["zona_1", "zona_4"].distance_km == 1.90 and edges["zona_4", "zona_1"].time_min == 3.8
    assert edges["zona_1", "zona_11"].distance_km == 4.52 and edges["zona_13", "antigua"].distance_km == 21.75
    km = {(r.from_zone, r.to_zone): r.distance_km for r in distances.collect()}
    assert round(km["zona_1", "zona_11"], 2) == 4.51  # shorter by way of another zone, as edges are rounded
    assert km["antigua", "antigua"] == 0.0
    assert all(abs(km[a, b] - km[b, a]) < 1e-9 for a, b in km)
    names = [zone for _, zone, *_ in ZONES]
    assert all(km[a, c] <= km[a, b] + km[b, c] + 1e-9 for a in names for b in names for c in names)


def pending(spark, orders, zones):
    df = spark.createDataFrame(orders, "order_id long, dest_zone string, batch long")
    place = zones.selectExpr("zone AS dest_zone", "lat AS dest_lat", "lon AS dest_lon")
    return df.join(place, "dest_zone").withColumns({"customer": F.lit("c"), "total": F.lit(1.0)})


def fleet(spark, rows, zones):
    df = spark.createDataFrame(rows, "courier_id long, name string, vehicle string, base_zone string")
    return routing.couriers_at_base(df, zones)


def test_known_dispatch(spark, zones, network, tmp_path):
    orders = sorted((order, zone, 1) for *_, stops in ROUTES for order, zone, _ in stops)
    couriers = fleet(spark, [(c, f"c{c}", "moto", base) for c, base, _, _ in ROUTES], zones)
    routes = routing.assign_routes(pending(spark, orders, zones), couriers, network)
    got = {}
    for r in routes.orderBy("courier_id", "seq").collect():
        got.setdefault(r.courier_id, []).append((r.order_id, r.dest_zone, round(r.distance_km, 2)))
    assert got == {c: stops for c, _, _, stops in ROUTES}
    summary = {r.courier_id: r for r in routing.route_summary(routes).collect()}
    assert {c: s.total_km for c, s in summary.items()} == {c: km for c, _, km, _ in ROUTES}
    assert round(sum(s.total_km for s in summary.values()), 2) == 61.64
    assert {s.batch_orders for s in summary.values()} == {60}
    nested = routing.routes_nested(routes, couriers).collect()
    assert len(nested) == 12 and all([o.order_id for o in n.orders] == [o for o, _, _ in got[n.courier_id]]
                                     for n in nested)
    assert write_json(routing.routes_nested(routes, couriers), str(tmp_path / "routes")) == 12
    stored = {r.courier_id: r for r in spark.read.json(str(tmp_path / "routes")).collect()}
    assert all(len(r.orders) == 5 and r.total_distance_km == summary[c].total_km for c, r in stored.items())


def greedy(orders, couriers, position, km):
    """orders: (id, zone); couriers: (id, zone, lat, lon)."""
    left, out = sorted(orders), []
    quota = math.ceil(len(left) / len(couriers))
    for c, zone, lat, lon in couriers:
        for seq in range(1, quota + 1):
            if not left:
                break
            pick = min(left, key=lambda o: (routing._km([lat], [lon], *[[x] for x in position[o[1]]])[0, 0], o[0]))
            left.remove(pick)
            out.append((c, seq, *pick, round(0.0 if zone == pick[1] else km.get((zone, pick[1]), 999.0), 6)))
            zone, (lat, lon) = pick[1], position[pick[1]]
    return out


def test_batches_are_independent(spark, zones, network, distances):
    import numpy as np
    import random

    rng = random.Random(5)
    names = [zone for _, zone, *_ in ZONES]
    position = {zone: (np.float64(lat), np.float64(lon)) for _, zone, _, lat, lon in ZONES}
    km = {(r.from_zone, r.to_zone): r.distance_km for r in distances.collect()}
    orders = [(i, rng.choice(names), i // 9 + 1) for i in range(60)]
    bases = [(1, "zona_9"), (2, "unknown"), (4, "antigua"), (7, "zona_1")]
    couriers = fleet(spark, [(c, "c", "moto", z) for c, z in bases], zones)
    routes = routing.assign_routes(pending(spark, orders, zones), couriers, network, batch_size=9)
    got = {}
    for r in routes.orderBy("batch", "courier_id", "seq").collect():
        got.setdefault(r.batch, []).append((r.courier_id, r.seq, r.order_id, r.dest_zone, round(r.distance_km, 6)))
    start = [(c, z, *position.get(z, (routing.DEFAULT_LAT, routing.DEFAULT_LON))) for c, z in bases]
    for batch in range(1, 8):  # a full batch uses three of the four couriers, and the next one begins after them
        turn = (batch - 1) * 3 % 4
        expected = greedy([(o, z) for o, z, b in orders if b == batch], start[turn:] + start[:turn], position, km)
        assert got[batch] == sorted(expected)


def test_more_couriers_than_a_batch_holds(spark, zones, network):
    """A fleet of 70 takes turns: 150 orders in batches of 60 reach everybody."""
    couriers = fleet(spark, [(10 * c, "c", "moto", "zona_1") for c in range(1, 71)], zones)
    orders = [(i, "zona_4", i // 60 + 1) for i in range(150)]
    routes = routing.assign_routes(pending(spark, orders, zones), couriers, network).collect()
    assert len(routes) == 150 and {r.courier_id for r in routes} == {10 * c for c in range(1, 71)} and {r.seq for r in routes} == {1}
    assert {r.courier_id for r in routes if r.batch == 1} == {10 * c for c in range(1, 61)}


@pytest.mark.parametrize("size", [7, 28, 40, 60, 70])
def test_every_courier_gets_work(spark, zones, size):
    """Ten full batches of 60: whatever the size of the fleet, batches go on where the one before stopped."""
    names = [zone for _, zone, *_ in ZONES]
    orders = [(600 * b + i, names[(b + i) % 7], b + 1) for b in range(10) for i in range(60)]
    couriers = fleet(spark, [(c, f"c{c}", "moto", names[c % 7]) for c in range(1, size + 1)], zones)
    stops = routing.assign_stops(pending(spark, orders, zones), couriers).collect()
    assert len(stops) == 600 and {r.courier_id for r in stops} == set(range(1, size + 1))
    quota = math.ceil(60 / size)
    assert max(r.seq for r in stops) == quota
    by_batch = [{r.courier_id for r in stops if r.batch == b} for b in range(1, 11)]
    assert all(len(used) == math.ceil(60 / quota) for used in by_batch)


def test_one_neighbourhood_is_the_known_dispatch(spark, zones, network):
    """All orders of one day, not more than a batch holds: the known routes."""
    orders = sorted((order, zone, 1) for *_, stops in ROUTES for order, zone, _ in stops)
    couriers = fleet(spark, [(c, f"c{c}", "moto", base) for c, base, _, _ in ROUTES], zones)
    batched = routing.batches_by_place(pending(spark, orders, zones).drop("batch"), F.lit("2025-01-01").cast("date"))
    got = {}
    for r in routing.assign_by_place(batched, couriers, network).orderBy("courier_id", "seq").collect():
        got.setdefault(r.courier_id, []).append((r.order_id, r.dest_zone, round(r.distance_km, 2)))
    assert got == {c: stops for c, _, _, stops in ROUTES}


@pytest.mark.parametrize(("size", "batch_size"), [(5, 8), (30, 8), (2, 20)])
def test_batches_by_place(spark, zones, network, size, batch_size):
    """A zone with a third of all orders, days of very different size: batches are bounded and near, everybody is used."""
    import random

    rng = random.Random(size)
    names = [zone for _, zone, *_ in ZONES]
    orders = [(i, "antigua" if i % 3 == 0 else rng.choice(names), 1) for i in range(150)]
    waiting = pending(spark, orders, zones).drop("batch").withColumn("day", F.expr("date_add(DATE'2025-01-01', cast(sqrt(order_id) / 3 AS int))"))
    batched = routing.batches_by_place(waiting, F.col("day"), batch_size)
    found = batched.collect()
    assert sorted(r.order_id for r in found) == list(range(150))
    batches = {}
    for r in found:
        batches.setdefault(r.batch, []).append(r)
    assert sorted(batches) == list(range(1, len(batches) + 1))
    days = {}
    for b, rows in batches.items():
        assert len({r.period for r in rows}) == 1 and len(rows) <= batch_size and {r.part for r in rows} == {rows[0].part}
        days.setdefault(rows[0].period, []).append((b, len(rows), rows[0].parts))
    for own in days.values():  # all but a day's last batch are full
        assert [n for _, n, _ in sorted(own)][:-1] == [batch_size] * (len(own) - 1) and {p for *_, p in own} == {len(own)}
    couriers = fleet(spark, [(c, "c", "moto", names[c % 7]) for c in range(size)], zones)
    stops = routing.assign_by_place(batched, couriers, network).collect()
    assert sorted(r.order_id for r in stops) == list(range(150)) and {r.courier_id for r in stops} == set(range(size))
    assert routing.assign_by_place(batched, couriers.limit(0), network).collect() == []


def test_nothing_to_dispatch(spark, zones, network):
    orders = pending(spark, [(1, "zona_4", 1)], zones)
    assert routing.assign_routes(orders, fleet(spark, [], zones), network).isEmpty()


def test_pending_batches(spark, small):
    waiting = routing.pending_orders(graph.orders(small), graph.placed(small), graph.delivered_to(small),
                                     graph.users(small), graph.locations(small), batch_size=1)
    assert [(r.order_id, r.batch, r.customer) for r in waiting.collect()] == [(102, 1, "Eva")]


def test_group_function_needs_no_package_on_the_workers(tmp_path):
    """The pickled function runs in a process that cannot import the package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys; sys.path.insert(0, {root!r})
from comanda.operators import routing
from pyspark import cloudpickle
open("function.pkl", "wb").write(cloudpickle.dumps(routing._dispatch))
"""
    load = """
import pickle, pandas as pd
dispatch = pickle.load(open("function.pkl", "rb"))
batch = pd.DataFrame({"batch": [1, 1], "order_id": [2, 1], "dest_zone": ["a", "b"], "dest_lat": [1.0, 2.0],
                      "dest_lon": [1.0, 2.0], "customer": ["x", "y"], "total": [1.0, 2.0]})
fleet = pd.DataFrame({"courier_id": [7], "base_zone": ["a"], "base_lat": [1.0], "base_lon": [1.0]})
print(dispatch(batch, fleet, 1)["order_id"].tolist())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, check=True)
    out = subprocess.run([sys.executable, "-c", load], cwd=tmp_path, env=env, check=True, capture_output=True, text=True)
    assert out.stdout.strip() == "[2, 1]"
