"""Users compared block by block: few bytes are stored and moved, and results don't depend on blocks."""

import os
import random
from collections import Counter

import numpy as np
import pytest

from comanda.operators import influence, recommend, visitors
from comanda.session import ensure_checkpoint_dir
from tests.test_graph_algorithms import brute_pagerank, random_visits, shared_counts


def stored_bytes(spark, run):
    """What a call leaves in the checkpoint folder."""
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    files = lambda: {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names}
    before = files()
    run()
    return sum(size for file, size in files().items() if file not in before)


@pytest.fixture(scope="module")
def each_its_own(spark):
    """2,000 users with different restaurants: two of 100 each, so no two unions are the same for long."""
    return spark.range(2000).selectExpr(
        "id AS user_id", "explode(array_distinct(array(id % 100, 100 + id div 20 % 100, 200 + id))) AS via_restaurant").localCheckpoint()


def test_influencers_store_visits_only(spark, each_its_own):
    users = spark.range(2000).selectExpr("id AS user_id", "'n' || id AS name", "'z' AS zone")
    assert stored_bytes(spark, lambda: influence.degree(each_its_own, users).collect()) < 2_000_000


@pytest.mark.parametrize(("dense", "matches"), [(1, 1), (3, 50), (32, 1 << 21), (10**6, 7)])
def test_known_by_bitmaps_and_by_matches(monkeypatch, dense, matches):
    monkeypatch.setattr(visitors, "DENSE", dense)
    monkeypatch.setattr(visitors, "MATCHES", matches)
    rng = random.Random(dense)
    sides = [{(rng.randrange(40), rng.choice([1, 2, 2, 3, rng.randrange(60)])) for _ in range(150)} for _ in range(2)]
    packed = [(np.arange(40), np.sort(np.array([r << visitors.REST_BIT | u for u, r in s]))) for s in sides]
    for two, same in ((1, False), (0, True)):
        expected = [len({v for v, r in sides[two] if (u, r) in sides[0] and (v > u or not same)}) for u in range(40)]
        assert visitors.known(packed[0], packed[two], same).tolist() == expected


def test_degrees_store_visits_only(spark, each_its_own):
    assert stored_bytes(spark, lambda: recommend.degrees(each_its_own).count()) < 2_000_000


def shuffled_bytes(df):
    """What the exchanges of the plan have written, once its rows are collected."""

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        metric = node.metrics().get("shuffleBytesWritten")
        below = [node.children().apply(i) for i in range(node.children().size())]
        return (metric.get().value() if metric.isDefined() else 0) + sum(map(walk, below))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_degrees_move_few_bytes(spark, monkeypatch):
    """16 blocks of 500 users who visit at random: two bytes for each visit and block, and a little for the counts."""
    monkeypatch.setattr(visitors, "BLOCK_BITS", 9)
    visits = spark.range(8000).selectExpr("id AS user_id", "explode(array_distinct(transform("
        "sequence(1, 20), x -> xxhash64(id, x) & 255))) AS via_restaurant").localCheckpoint()
    assert shuffled_bytes(recommend.degrees(visits)) < 2.5 * 16 * visits.count()


def test_users_without_acquaintances_are_told_once(spark, monkeypatch):
    """Users of two blocks who share nothing: no rows but those of a block with itself."""
    monkeypatch.setattr(visitors, "BLOCK_BITS", 4)
    rows, over_pairs = [], visitors.over_pairs

    def counted(*args):
        out = over_pairs(*args)
        rows.append(out.count())
        return out

    monkeypatch.setattr(visitors, "over_pairs", counted)
    df = spark.range(64).selectExpr("id AS user_id", "id div 4 AS via_restaurant").localCheckpoint()
    got = {r.user_id: r.recommends for r in recommend.degrees(df).collect()}
    assert rows == [64] and got == {u: 3 - u % 4 for u in range(64)}


@pytest.mark.parametrize("numbers", [[], [7], [-(2**63), -1, 0, 5, 5, 2**63 - 1], [r << 32 | u for r in range(9) for u in range(r, 99, 7)]])
def test_deflated_numbers_come_back(numbers):
    numbers = np.array(numbers, np.int64)
    assert visitors.inflated(visitors.deflated(numbers)).tolist() == numbers.tolist()


def test_pairs_are_not_moved(spark):
    """Pairs are counted where two blocks meet: no join or exchange above them but that of the best."""
    df = spark.createDataFrame(sorted(random_visits(7)), "user_id long, via_restaurant long")
    plan = recommend.top_recommendations(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hash") <= 2


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(visitors, "BLOCK_BITS", 4)
    visits = random_visits(9)
    df = spark.createDataFrame(sorted(visits) + [(None, 1), (3, None)], "user_id long, via_restaurant long").localCheckpoint()
    assert visitors.blocks(df).count == 6
    pairs = shared_counts(visits)
    assert {(r.from_user, r.to_user): r.shared for r in recommend.sharing(df).collect()} == {p: n for p, n in pairs.items() if n >= 2}
    out = Counter(a for a, _ in pairs)
    assert {r.user_id: r.recommends for r in recommend.degrees(df).collect()} == {u: out[u] for u, _ in visits}


def test_pagerank_stores_pairs_packed(spark):
    """500 users of four restaurants: 124,750 pairs, some numbers each; and the same scores without broadcasts."""
    visits = [(u, r) for u in range(500) for r in range(4)]
    df = spark.createDataFrame([(u, r, u, 499 - u) for u, r in visits], "user_id long, via_restaurant long, recommended_by long, recommends long")
    got = {}
    assert stored_bytes(spark, lambda: got.update((r.id, r.score) for r in influence.pagerank(df, 1).collect())) < 2_500_000
    expected = brute_pagerank(visits, 1)
    assert got.keys() == expected.keys() and all(abs(got[u] - expected[u]) < 1e-9 for u in got)


def test_pagerank_in_blocks_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(influence, "BROADCAST_USERS", 0)
    monkeypatch.setattr(influence, "PIECE_BITS", 4)
    visits = sorted(random_visits(5))
    at = {r: sorted(u for u, s in visits if s == r) for _, r in visits}
    rows = [(u, r, at[r].index(u), len(at[r]) - 1 - at[r].index(u)) for u, r in visits]
    df = spark.createDataFrame(rows, "user_id long, via_restaurant long, recommended_by long, recommends long")
    got, expected = {r.id: r.score for r in influence.pagerank(df, 3).collect()}, brute_pagerank(visits, 3)
    assert got.keys() == expected.keys() and all(abs(got[u] - expected[u]) < 1e-9 for u in got)
