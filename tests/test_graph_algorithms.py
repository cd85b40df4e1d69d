"""Pruned or iterated operators against brute force on small random data."""

import heapq
import itertools
import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest

from comanda.operators import basket, graph, influence, paths, recommend


def test_recommendations(spark, small):
    rng = random.Random(3)
    visits = [(u, 0) for u in range(0, 120, 2)]  # one restaurant with half of all users
    visits += [(rng.randrange(120), rng.randrange(1, 9)) for _ in range(150)]
    rows = [(i, u, r, None, "completed", 1.0, "card") for i, (u, r) in enumerate(visits)]
    t = replace(small, orders=spark.createDataFrame(rows, small.orders.schema))
    at = defaultdict(set)
    for u, r in visits:
        at[r].add(u)
    every = sorted(((a, b, r) for r, us in at.items() for a, b in itertools.combinations(sorted(us), 2)),
                   key=lambda e: (e[1], e[0], e[2]))
    for limit in (1, 7, 40, 300, len(every) + 5):
        got = [tuple(row) for row in graph.first_recommendations(t, limit).collect()]
        assert got == every[:limit]
    recommends, recommended_by = Counter(), Counter()
    for a, b, r in every:
        recommends[a, r] += 1
        recommended_by[b, r] += 1
    visits_ = graph.recommendations(t)
    assert {(r.user_id, r.via_restaurant): (r.recommended_by, r.recommends) for r in visits_.collect()} == {
        (u, r): (recommended_by[u, r], recommends[u, r]) for r, us in at.items() for u in us}
    merged = Counter((a, b) for a, b, _ in every)  # a pair has one edge
    out = Counter(a for a, _ in merged)
    assert {r.user_id: r.recommends for r in recommend.degrees(graph.visits(t)).collect()} == {
        u: out[u] for u in {u for u, _ in visits}}
    users = spark.createDataFrame([(u, f"u{u:03d}", "z") for u in range(120)], "user_id long, name string, zone string")
    best = sorted(out.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [(r.user_name, r.recommended_users) for r in influence.degree(graph.visits(t), users).collect()] == [
        (f"u{u:03d}", n) for u, n in best]


def shared_counts(visits):
    at = defaultdict(set)
    for u, r in visits:
        at[r].add(u)
    return Counter((a, b) for us in at.values() for a, b in itertools.combinations(sorted(us), 2))


def random_visits(seed):
    """A restaurant that nearly everybody knows, one with a third of all visits, and small ones; ids far apart."""
    rng = random.Random(seed)
    ids = sorted(rng.sample(range(-10**12, 10**12), 90))
    visits = {(u, 1) for u in ids[5:]} | {(u, -7) for u in ids[::2]}
    return visits | {(rng.choice(ids), 10 ** rng.randrange(9)) for _ in range(120)} | {(ids[0], 77)}


@pytest.mark.parametrize("least", [1, 2, 3, 4])
def test_pairs_that_share_restaurants(spark, least):
    visits = random_visits(least)
    df = spark.createDataFrame(sorted(visits), "user_id long, via_restaurant long")
    expected = {pair: n for pair, n in shared_counts(visits).items() if n >= least}
    assert {(r.from_user, r.to_user): r.shared for r in recommend.sharing(df, least).collect()} == expected
    best = defaultdict(list)
    for (a, b), n in expected.items():
        best[a].append((-n, b))
    assert {(r.from_user, r.place): (r.to_user, r.shared) for r in recommend.top_recommendations(df, least, 3).collect()} == {
        (a, i + 1): (b, -n) for a, others in best.items() for i, (n, b) in enumerate(sorted(others)[:3])}


def test_a_restaurant_of_all_makes_no_pairs(spark):
    """Everybody's most visited restaurant is left out before pairs are formed."""
    visits = [(u, 1) for u in range(3000)] + [(u, 2 + u // 2) for u in range(3000)]
    df = spark.createDataFrame(visits, "user_id long, via_restaurant long")
    found = recommend.sharing(df)
    assert found.count() == 1500 and found.filter("to_user <> from_user + 1 OR shared <> 2").isEmpty()
    plan = found._jdf.queryExecution().executedPlan()
    found.collect()
    assert "CartesianProduct" not in plan.toString()


def test_degrees_over_several_bitmaps(spark):
    """70,000 users: three blocks of bitmaps; a restaurant of all, and one restaurant for each ten users."""
    visits = spark.range(70_000).selectExpr("id * 3 AS user_id", "explode(array(-1L, id div 10)) AS via_restaurant").filter(
        "user_id <> 30 OR via_restaurant >= 0")
    found = {r.user_id: r.recommends for r in recommend.degrees(visits).filter("user_id < 100 OR user_id > 209900").collect()}
    assert found[0] == 69_999 - 1 and found[3] == 69_998 - 1 and found[30] == 9 and found[33] == 70_000 - 12
    assert found[209_997] == 0 and found[209_994] == 1 and len(found) == 34 + 33
    same = spark.createDataFrame([(u, r) for u in range(5) for r in (1, 2)] + [(9, 3)], "user_id long, via_restaurant long")
    assert {r.user_id: r.recommends for r in recommend.degrees(same).collect()} == {0: 4, 1: 3, 2: 2, 3: 1, 4: 0, 9: 0}
    nobody = spark.createDataFrame([], "user_id long, via_restaurant long")
    assert recommend.degrees(nobody).collect() == recommend.sharing(nobody).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_copurchase(spark, seed):
    rng = random.Random(seed)
    names = {p: f"n{p % 12}" for p in range(30)}  # several products share a name
    lines = {(0, p) for p in range(30)}  # one order with every product
    lines |= {(rng.randrange(1, 25), min(int(rng.expovariate(0.15)), 29)) for _ in range(90)}
    orders = defaultdict(set)
    for o, p in lines:
        orders[o].add(p)
    count = Counter()
    for o, ps in orders.items():
        count.update({(names[a], names[b]) for a, b in itertools.combinations(sorted(ps), 2)})
    expected = sorted(((a, b, n) for (a, b), n in count.items()), key=lambda x: (-x[2], x[0], x[1]))
    rows = sorted(lines) + rng.sample(sorted(lines), 20)  # repeated lines change nothing
    edges = spark.createDataFrame(rows, "order_id long, prod_id long")
    products = spark.createDataFrame(list(names.items()), "prod_id long, name string")
    for probe in (2, 5, 12):
        assert [tuple(r) for r in basket.copurchase(edges, products, probe=probe).collect()] == expected[:5]


def test_copurchase_with_fewer_pairs_than_asked(spark):
    edges = spark.createDataFrame([(1, 1), (1, 2)], "order_id long, prod_id long")
    products = spark.createDataFrame([(1, "a"), (2, "b")], "prod_id long, name string")
    assert [tuple(r) for r in basket.copurchase(edges, products).collect()] == [("a", "b", 1)]


def test_top_products(spark):
    edges = spark.createDataFrame([(o, p, q) for o, p, q in [(1, 1, 3), (2, 2, 3), (3, 3, 1), (4, 4, 9), (5, 1, 1)]],
                                  "order_id long, prod_id long, quantity int")
    products = spark.createDataFrame([(1, "x", "A"), (2, "y", "A"), (3, "z", "A"), (4, "w", "A"), (9, "u", "B")],
                                     "prod_id long, name string, category string")
    row = basket.top_products_nested(edges, products).collect()
    assert [(r.category, [tuple(b) for b in r.best]) for r in row] == [("A", [("w", 9), ("x", 4), ("y", 3)])]


def brute_pagerank(visits, rounds):
    at = defaultdict(set)
    for u, r in visits:
        at[r].add(u)
    edges = {(a, b) for us in at.values() for a, b in itertools.combinations(sorted(us), 2)}
    out = Counter(s for s, _ in edges)
    score = {u: 0.15 for u, _ in visits}
    for _ in range(rounds):
        new = dict.fromkeys(score, 0.15)
        for s, d in edges:
            new[d] += 0.85 * score[s] / out[s]
        score = new
    return score


@pytest.mark.parametrize(("rounds", "bits"), [(1, 17), (3, 2), (20, 4)])
def test_pagerank(spark, small, rounds, bits, monkeypatch):
    monkeypatch.setattr(influence, "PIECE_BITS", bits)  # restaurants of one or of many pieces
    rng = random.Random(11)
    visits = {(u, 0) for u in range(0, 400_000, 9_000)}  # one restaurant over several ranges of ids
    visits |= {(9_000 * rng.randrange(45), rng.randrange(1, 6)) for _ in range(60)} | {(7, 9)}
    rows = [(i, u, r, None, "completed", 1.0, "card") for i, (u, r) in enumerate(sorted(visits))]
    recommendations = graph.recommendations(replace(small, orders=spark.createDataFrame(rows, small.orders.schema)))
    got = {r.id: r.score for r in influence.pagerank(recommendations, max_iterations=rounds, tolerance=0.0).collect()}
    expected = brute_pagerank(visits, rounds)
    assert got.keys() == expected.keys() and all(abs(got[n] - expected[n]) < 1e-9 for n in got)


def test_large_baskets_are_cut_into_blocks(spark):
    """An order of 500 names: no key holds more than two blocks of names, and all pairs are counted."""
    lines = spark.range(500).selectExpr("1L AS order_id", "id AS prod_id")
    names = spark.range(500).selectExpr("id AS prod_id", "concat('n', lpad(id, 3, '0')) AS name")
    top = basket.copurchase(lines, names, limit=200_000)
    assert top.count() == 500 * 499 // 2
    baskets = basket._names_in_orders(lines, names)
    assert basket._pair_orders(baskets).agg({"orders_together": "max"}).first()[0] == 1


def random_network(seed):
    rng = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(14)]
    edges = {}
    for i, n in enumerate(nodes[:11]):  # a chain and some shortcuts; the last three nodes stand apart
        if i:
            edges[nodes[i - 1], n] = round(rng.uniform(1, 9), 2)
    for _ in range(8):
        a, b = rng.sample(nodes[:11], 2)
        edges.setdefault((a, b), round(rng.uniform(1, 30), 2))
    edges[nodes[11], nodes[12]] = 1.0
    return nodes, edges


def dijkstra(nodes, edges, start):
    near = defaultdict(list)
    for (a, b), km in edges.items():
        near[a].append((b, km))
        near[b].append((a, km))
    best, queue = {}, [(0.0, start)]
    while queue:
        km, n = heapq.heappop(queue)
        if n in best:
            continue
        best[n] = km
        for m, leg in near[n]:
            heapq.heappush(queue, (km + leg, m))
    return best


@pytest.mark.parametrize("seed", [1, 2])
def test_lightest_paths(spark, seed):
    nodes, edges = random_network(seed)
    df = paths.both_ways(spark.createDataFrame([(a, b, km) for (a, b), km in edges.items()],
                                               "src string, dst string, km double"))
    sources = spark.createDataFrame([(n,) for n in nodes], "src string")
    got = paths.lightest_paths(df, sources).collect()
    for n in nodes:
        expected = dijkstra(nodes, edges, n)
        mine = {r.dst: r.km for r in got if r.src == n}
        assert mine.keys() == expected.keys()
        assert all(abs(mine[m] - expected[m]) < 1e-9 for m in mine)
    for r in got:
        assert r.route[0] == r.src and r.route[-1] == r.dst and r.costs[-1] == r.km and len(r.costs) == len(r.route)


@pytest.mark.parametrize("seed", [1, 2])
def test_zone_distance(spark, seed):
    """From some nodes only; without a path the distance is 999."""
    nodes, edges = random_network(seed)
    df = paths.both_ways(spark.createDataFrame([(a, b, km) for (a, b), km in edges.items()],
                                               "src string, dst string, km double"))
    pairs = [(a, b) for a in nodes[::3] for b in nodes]
    got = paths.zone_distance(spark.createDataFrame(pairs, "from_zone string, to_zone string"), df).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert r.distance_km == round(dijkstra(nodes, edges, r.from_zone).get(r.to_zone, 999.0), 2)


def test_fewest_hops(spark):
    edges = [("a", "b", 1.0), ("b", "d", 1.0), ("a", "c", 1.0), ("c", "d", 5.0), ("d", "e", 2.0), ("x", "y", 1.0)]
    df = paths.both_ways(spark.createDataFrame(edges, "src string, dst string, km double"))
    row = paths.fewest_hops(df, "a", "e").first()
    assert row.route == ["a", "b", "d", "e"] and row.legs_km == [1.0, 1.0, 2.0] and row.total_km == 4.0
    assert paths.fewest_hops(df, "a", "y").isEmpty()
    assert paths.fewest_hops(df, "a", "a").first().route == ["a"]


def every_path(edges, start, end, most):
    """All simple paths of at most ``most`` edges, in a graph of edges for both directions: (hundredths, hops, route)."""
    near = defaultdict(dict)
    for (a, b), km in edges.items():
        near[a][b] = near[b][a] = min(km, near[a].get(b, km))
    stack, out = [(0, (start,))], []
    while stack:
        length, route = stack.pop()
        if route[-1] == end:
            out.append((length, len(route) - 1, route))
        elif len(route) <= most:
            stack += [(length + round(km * 100), (*route, n)) for n, km in near[route[-1]].items() if n not in route]
    return out


def as_edges(spark, edges):
    return spark.createDataFrame([(a, b, km) for (a, b), km in edges.items()], "src string, dst string, km double")


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_ways_between_two_nodes(spark, seed):
    """A sparse network with many equal legs, so that ties decide; and two nodes without a way."""
    rng = random.Random(seed)
    nodes = [f"n{i:02d}" for i in rng.sample(range(100), 16)]
    edges = {(nodes[i - 1], nodes[i]): rng.choice([1.0, 2.0, 0.5]) for i in range(1, 14)}
    for _ in range(7):
        a, b = rng.sample(nodes[:14], 2)
        edges.setdefault((a, b), rng.choice([1.0, 2.0, 3.5]))
    edges[nodes[14], nodes[15]] = 1.0
    df = as_edges(spark, edges)
    for start, end in [(nodes[0], nodes[13]), (nodes[13], nodes[2]), (nodes[5], nodes[5])]:
        ways = every_path(edges, start, end, 14)
        hops = paths.fewest_hops(df, start, end).collect()[0]
        length, n, route = min(ways, key=lambda w: (w[1], w[2]))
        assert tuple(hops.route) == route and len(hops.legs_km) == n and abs(hops.total_km - length / 100) < 1e-9
        best = paths.lightest_path(paths.both_ways(df), start, end).collect()[0]
        length, n, route = min(ways)
        assert (best.src, best.dst, tuple(best.route), round(best.km * 100)) == (start, end, route, length)
        assert best.costs[0] == 0 and best.costs[-1] == best.km and best.costs == sorted(best.costs)
    assert paths.fewest_hops(df, nodes[0], nodes[15]).collect() == []
    assert paths.lightest_path(paths.both_ways(df), nodes[0], nodes[15]).collect() == []


def test_one_way_streets(spark):
    df = as_edges(spark, {("a", "b"): 1.0, ("b", "c"): 1.0, ("c", "a"): 5.0})
    assert paths.lightest_path(df, "a", "c").first().route == ["a", "b", "c"]
    assert paths.lightest_path(df, "c", "b").first().route == ["c", "a", "b"]


def test_a_long_chain_has_the_plan_of_a_short_one(spark, monkeypatch):
    """Twelve levels from either side: no stored table's plan grows with its depth."""
    sizes = []
    cut = paths.cut_lineage

    def measured(df):
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
        return cut(df)

    monkeypatch.setattr(paths, "cut_lineage", measured)
    chain = as_edges(spark, {(f"n{i:02d}", f"n{i + 1:02d}"): 1.5 for i in range(24)})
    found = paths.fewest_hops(chain, "n00", "n24").collect()[0]
    assert found.route == [f"n{i:02d}" for i in range(25)] and found.total_km == 36.0
    assert max(sizes[10:]) <= 1.2 * max(sizes[:6])


@pytest.mark.parametrize("seed", [6, 7])
def test_lengths_by_buckets(spark, seed):
    """Legs of very different lengths, from several sources; zero legs too."""
    rng = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(30)]
    edges = {tuple(rng.sample(nodes, 2)): rng.choice([0.0, 0.01, 0.5, 3.0, 90.0]) for _ in range(70)}
    df = paths.both_ways(as_edges(spark, edges))
    got = paths.settled(df, spark.createDataFrame([(n,) for n in nodes[:3]], "src string")).collect()
    assert len(got) == len({(r.src, r.dst) for r in got})
    for n in nodes[:3]:
        expected = dijkstra(nodes, {p: round(km * 100) for p, km in edges.items()}, n)
        assert {r.dst: r.length for r in got if r.src == n} == expected
