"""Influential users: out-degree and PageRank on merged recommendations, without listing the pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.operators import recommend, visitors
from comanda.session import cut_lineage

DAMPING = 0.85
MAX_ITERATIONS = 20
TOLERANCE = 1e-7
ROUNDS_PER_LOOK = 5  # after so many rounds it is looked whether scores still change
PIECE_BITS = 15  # fewer users than this are not cut into blocks
ROW_PAIRS = 1 << 20  # pairs in a row, that share two or more restaurants
BROADCAST_USERS = 8_000_000  # a number for each: 64 MB
GAINS = "block int, got array<double>"
SCORES = "block int, weight array<double>, score array<double>, gives array<double>, change double"


def degree(visits: DataFrame, users: DataFrame, limit: int = 10) -> DataFrame:
    """Users who recommend most others, ties by name and zone. A user counts once, however many restaurants are shared."""
    named = users.select("user_id", F.col("name").alias("user_name"), "zone")
    return (
        recommend.degrees(visits)
        .join(named, "user_id")
        .groupBy("user_name", "zone")
        .agg(F.sum("recommends").alias("recommended_users"))
        .orderBy(F.desc("recommended_users"), "user_name", "zone")
        .limit(limit)
    )


def _sums_before(recommended: visitors.Blocks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What users get from those with smaller ids at each restaurant: running sums over a part's blocks, in order."""
    count, size, restaurants = recommended.count, recommended.size, recommended.restaurants

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            for part, block, codes, gives in zip(*(batch.column(c) for c in ("part", "block", "codes", "gives"))):
                if part.as_py() != at:
                    at = part.as_py()
                    low, given = at * restaurants // count, np.zeros(restaurants // count + 2)
                codes = np.sort(codes.values.to_numpy(zero_copy_only=False) & ~np.int64(1 << visitors.TOP_BIT))
                place, rest = codes & visitors.PLACE, (codes >> visitors.REST_BIT) - 1 - low
                part_of = gives.values.to_numpy(zero_copy_only=False)[place]
                before = np.cumsum(part_of) - part_of
                before += given[rest] - before[np.searchsorted(rest, rest)]
                given += np.bincount(rest, part_of, len(given))
                got = np.bincount(place, before, size)
                yield pa.RecordBatch.from_pydict({"block": pa.array([block.as_py()], pa.int32()), "got": [got]})

    return gains


def _surplus(of: str, to: str, at: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What pairs that share several restaurants take off, by user ``to`` in block ``at``: the surplus, times what ``of`` gives."""

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for i, block in enumerate(batch.column(at).to_pylist()):
                read = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                weights = read("surplus") * (read("gives")[read(of)] if of else 1.0)
                sums[block] = sums.get(block, 0.0) - np.bincount(read(to), weights, size)
        for block, got in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "got": [got]})

    return taken


def _pairs(found: visitors.Blocks) -> DataFrame:
    """Pairs that share two or more restaurants, packed: (lo, hi, giver, getter, surplus), places of users in two blocks."""

    def ask(lo: int, hi: int, one: tuple, two: tuple) -> Iterator[dict]:
        held, rows = [], 0

        def row() -> dict:
            giver, getter, shared = (np.concatenate(c).astype(np.int32) for c in zip(*held))
            return {"lo": pa.array([lo], pa.int32()), "hi": pa.array([hi], pa.int32()), "giver": [giver], "getter": [getter],
                    "surplus": [shared - 1]}

        for pairs in visitors.sharing(one, two, lo == hi, 2):
            held.append(pairs)
            rows += len(pairs[0])
            if rows >= ROW_PAIRS:
                yield row()
                held, rows = [], 0
        if rows:
            yield row()

    return visitors.over_pairs(found, ask, "lo int, hi int, giver array<int>, getter array<int>, surplus array<int>")


def pagerank(
    recommendations: DataFrame,
    max_iterations: int = MAX_ITERATIONS,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(id, score) of every visitor; score = 1-d + d * sum(score/degree) over those who recommend the user.

    ``recommendations`` has a row for each visit, as ``graph.recommendations`` gives them. What a user gets at a restaurant
    is a running sum over its visitors with smaller ids. That counts a pair once for each restaurant it shares; a table of
    the pairs that share two or more takes the surplus off again, from sums and from degrees. Users are cut into blocks;
    visits lie by ranges of restaurants, and pairs where they were found, both packed and as stored, for all rounds. A round
    gives them what each user of a block gives, and moves what a block gets from a range or from another block.
    """
    base = 1 - damping
    visits = cut_lineage(recommendations)
    found = visitors.blocks(visits, tops=1, bits=PIECE_BITS)
    size, pairs = found.size, cut_lineage(_pairs(found))
    by_range = lambda df: df.repartition(found.count, "part").sortWithinPartitions("part", "block")
    lying = cut_lineage(by_range(found.visits))

    edges = visits.groupBy("user_id").agg(F.sum("recommends").cast("double").alias("n")).join(found.numbers, "user_id")
    edges = edges.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("n")).select(
        "block", F.col("n.n").alias("got"))
    edges = edges.unionByName(pairs.mapInArrow(_surplus("", "giver", "lo", size), GAINS))

    def total(batches: Iterator[pa.RecordBatch]) -> tuple[int, np.ndarray, dict | None]:
        got, state = np.zeros(size), None
        for batch in batches:
            for row in range(batch.num_rows):
                block, sums = batch.column("block")[row].as_py(), batch.column("got")[row]
                if sums.is_valid:
                    sums = sums.values.to_numpy(zero_copy_only=False)
                    got[: len(sums)] += sums
                else:
                    state = {c: batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("weight", "score")}
        return block, got, state

    def scored(block: int, weight: np.ndarray, score: np.ndarray, change: float) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int32()), "weight": [weight], "score": [score], "gives": [weight * score], "change": [change]})

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, _ = total(batches)
        weight = np.divide(1.0, n, out=np.zeros(size), where=n > 0)
        yield scored(block, weight, np.full(size, base), float("inf"))

    def proceed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, got, state = total(batches)
        score = base + damping * got
        yield scored(block, state["weight"], score, float(np.abs(score - state["score"]).max()))

    users = found.count * size
    scores = cut_lineage(edges.groupBy("block").applyInArrow(begin, SCORES))
    for done in range(1, max_iterations + 1):
        gives = scores.select("block", "gives")
        if users <= BROADCAST_USERS:
            at_visits = lying.join(F.broadcast(gives), "block")
            at_pairs = pairs.join(F.broadcast(gives), pairs.lo == gives.block)
        else:  # joined by shuffle
            at_visits = by_range(lying.join(gives, "block"))
            at_pairs = pairs.join(gives, pairs.lo == gives.block)
        gains = at_visits.mapInArrow(_sums_before(found), GAINS).unionByName(
            at_pairs.drop("block").mapInArrow(_surplus("giver", "getter", "hi", size), GAINS))
        met = scores.select("block", "weight", "score").unionByName(gains, allowMissingColumns=True)
        scores = cut_lineage(met.groupBy("block").applyInArrow(proceed, SCORES))
        if done % ROUNDS_PER_LOOK == 0 and scores.filter(F.col("change") >= tolerance).isEmpty():
            break
    named = scores.join(found.users, "block").select(  # the last block may have fewer users than places
        F.explode(F.arrays_zip("ids", F.slice("score", F.lit(1), F.size("ids")).alias("score"))).alias("user"))
    return named.select(F.col("user.ids").alias("id"), F.col("user.score").alias("score"))


def top_pagerank(recommendations: DataFrame, users: DataFrame, limit: int = 10) -> DataFrame:
    """Users with the highest score, users without any visit included; ties by name and zone."""
    scores = pagerank(recommendations)
    ranked = users.select(F.col("user_id").alias("id"), F.col("name").alias("user_name"), "zone")
    score = F.round(F.coalesce("score", F.lit(1 - DAMPING)), 4)
    return (
        ranked.join(scores, "id", "left")
        .select("user_name", "zone", score.alias("pagerank_score"))
        .orderBy(F.desc("pagerank_score"), "user_name", "zone")
        .limit(limit)
    )
