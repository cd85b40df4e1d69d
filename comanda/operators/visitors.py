"""Users who visit the same restaurants, compared block by block.

The pairs of a restaurant's visitors grow with their square, so they are neither shuffled nor stored. Users are numbered by id
and cut into blocks; visits go, packed as whole numbers, to one task for every two blocks. Such a task has all that its users
share, forms the pairs of some users at a time, and hands on what is asked about them. Moved are visits times blocks, whose number
does not grow until a block would be too large for a task; on the way the numbers are gaps, deflated once for all blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.operators.keys import dense_key
from comanda.session import cut_lineage

BLOCK_BITS = 15  # fewer users than this are not cut
BLOCKS = 24  # 300 tasks
BLOCK_VISITS = 6_000_000  # beyond, there are more blocks: 8 bytes each, and a task holds two blocks
MATCHES = 1 << 21  # pairs formed at a time
DENSE = 32  # a restaurant that more than one of so many users of a block visits is a bitmap there
REST_BIT, TOP_BIT = 32, 31  # a visit as a number: restaurant, whether it is among the user's most visited ones, user in its block
PLACE = (1 << TOP_BIT) - 1

Pairs = Iterator[tuple[np.ndarray, ...]]


class Blocks(NamedTuple):
    count: int
    size: int  # users in a block
    restaurants: int
    numbers: DataFrame  # (user_id, block, place)
    users: DataFrame  # (block, ids), in order
    visits: DataFrame  # (block, part, codes), in order; parts are ranges of restaurants, as many as blocks


def blocks(visits: DataFrame, tops: int = 0, bits: int | None = None) -> Blocks:
    """Stored, distinct ``visits`` (user_id, via_restaurant) by blocks; marks each user's ``tops`` most visited restaurants."""
    visits = visits.select("user_id", "via_restaurant").dropna()
    numbers = cut_lineage(dense_key(visits.select("user_id").distinct(), "user_id", "no"))
    frequency = visits.groupBy("via_restaurant").agg(F.count(F.lit(1)).alias("visitors"))
    places = cut_lineage(dense_key(frequency, "via_restaurant", "rest"))
    users = numbers.count()
    restaurants, rows = places.agg(F.count(F.lit(1)), F.coalesce(F.sum("visitors"), F.lit(0))).first()
    count = max(1, min(BLOCKS, -(-users >> (BLOCK_BITS if bits is None else bits))), -(-rows // BLOCK_VISITS))
    size = max(1, -(-users // count))
    numbers = numbers.select(
        "user_id", F.expr(f"cast((no - 1) div {size} AS int)").alias("block"), F.expr(f"(no - 1) % {size}").alias("place"))
    known = visits.join(places, "via_restaurant")
    top = F.lit(0)
    if tops:
        known = known.withColumn("_rank", F.row_number().over(
            W.partitionBy("user_id").orderBy(F.desc("visitors"), "via_restaurant")))
        top = (F.col("_rank") <= tops).cast("int")
    code = F.shiftleft("rest", REST_BIT).bitwiseOR(F.shiftleft(top.cast("bigint"), TOP_BIT)).bitwiseOR(F.col("place"))
    part = F.expr(f"cast((rest - 1) * {count} div {max(restaurants, 1)} AS int)")
    coded = known.join(numbers, "user_id").select("block", part.alias("part"), code.alias("code"))
    packed = lambda df, column, *by: df.repartition(*by).groupBy(*by).agg(
        F.sort_array(F.collect_list(column)))
    return Blocks(
        count, size, restaurants, numbers, cut_lineage(packed(numbers, "user_id", "block").toDF("block", "ids")),
        cut_lineage(packed(coded, "code", "block", "part").toDF("block", "part", "codes")))


def deflated(numbers: np.ndarray) -> bytes:
    """Whole numbers in order as their gaps, byte by byte: the high bytes are nearly all equal."""
    return zlib.compress(np.diff(numbers, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def inflated(packed: bytes) -> np.ndarray:
    gaps = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(gaps).view(np.int64).ravel())


def _deflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [deflated(row.values.to_numpy(zero_copy_only=False)) for row in batch.column("codes")]
        yield pa.RecordBatch.from_pydict(
            {"block": batch.column("block"), "part": batch.column("part"), "codes": pa.array(codes, pa.binary())})


def over_pairs(found: Blocks, ask: Callable[..., Iterator[dict]], schema: str) -> DataFrame:
    """What ``ask`` yields for every two blocks, a block with itself too: it gets (lo, hi) and of each the ids and the codes."""
    rows = found.visits.unionByName(found.users.select("block", F.lit(-1).alias("part"), F.col("ids").alias("codes")))
    other = F.explode(F.sequence(F.lit(0), F.lit(found.count - 1))).alias("other")
    rows = rows.mapInArrow(_deflate, "block int, part int, codes binary").select("block", "part", "codes", other).select(
        F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "part", "codes")

    def of_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = {}
        for batch in batches:
            lo, hi = batch.column("lo")[0].as_py(), batch.column("hi")[0].as_py()
            for block, part, codes in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), batch.column("codes")):
                got[block, part] = inflated(codes.as_py())
        side = lambda block: (
            got[block, -1], np.concatenate([got[key] for key in sorted(got) if key[0] == block and key[1] >= 0]))
        for columns in ask(lo, hi, side(lo), side(hi)):
            yield pa.RecordBatch.from_pydict(columns)

    tasks = found.count * (found.count + 1) // 2
    return rows.repartition(tasks, "lo", "hi").groupBy("lo", "hi").applyInArrow(of_two, schema)


def _lists(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each visit in a, by user: the user, and where the restaurant's visitors in b begin and how many count.
    Where it is among the most visited ones of both, nobody counts: those who mark it come last in b."""
    start = a >> REST_BIT << REST_BIT
    first = np.searchsorted(b, start)
    size = np.searchsorted(b, start + np.where(a >> TOP_BIT & 1, 1 << TOP_BIT, 1 << REST_BIT)) - first
    row = a & PLACE
    order = np.argsort(row, kind="stable")
    order = order[size[order] > 0]
    return row[order], first[order], size[order]


def _matches(row: np.ndarray, first: np.ndarray, size: np.ndarray, b: np.ndarray, same: bool) -> Iterator[np.ndarray]:
    """Matches (user in a, user in b) as sorted numbers, all those of a user in one array."""
    ends, place, at = np.cumsum(size), b & PLACE, 0
    while at < len(row):
        stop = max(at + 1, np.searchsorted(ends, (ends[at - 1] if at else 0) + MATCHES, "right"))
        stop = np.searchsorted(row, row[stop - 1], "right")
        n = size[at:stop]
        other = place[np.repeat(first[at:stop] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        one = np.repeat(row[at:stop], n)
        key = one << TOP_BIT | other
        if same:
            key = key[other > one]
        key.sort()
        yield key
        at = stop


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers of a sorted array, and how often each is there."""
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else np.zeros(1, int)
    return key[edge[:-1]], np.diff(edge)


def _marked(codes: np.ndarray, users: int, tops: int, none: int) -> np.ndarray:
    """A row for each user: its most visited restaurants."""
    codes = codes[codes >> TOP_BIT & 1 == 1]
    place = codes & PLACE
    order = np.argsort(place, kind="stable")
    place = place[order]
    out = np.full((users, tops), none)
    out[place, np.arange(len(place)) - np.searchsorted(place, place)] = codes[order] >> REST_BIT
    return out


def sharing(one: tuple, two: tuple, same: bool, least: int, best: int | None = None) -> Pairs:
    """(user, other, shared) of pairs that share at least ``least`` restaurants; the ``best`` of each user only, if given."""
    (ids, a), (others, b), tops = one, two, least - 1
    mine, theirs = _marked(a, len(ids), tops, -1), _marked(b, len(others), tops, -2)
    for key in _matches(*_lists(a, b), b, same):
        key, shared = _runs(key)
        row, other = key >> TOP_BIT, key & PLACE
        for i in range(tops):
            for j in range(tops):
                shared = shared + (mine[row, i] == theirs[other, j])
        keep = shared >= least
        row, other, shared = row[keep], other[keep], shared[keep]
        if best is not None:
            order = np.lexsort((other, -shared, row))
            order = order[np.arange(len(row)) - np.searchsorted(row, row) < best]
            row, other, shared = row[order], other[order], shared[order]
        yield row, other, shared


def known(one: tuple, two: tuple, same: bool) -> np.ndarray:
    """How many different users of the second block, with larger ids, each user of the first shares a restaurant with.

    Users of restaurants with many visitors look their acquaintances up in bitmaps, the others count different matches.
    """
    (ids, a), (others, b) = one, two
    row, first, size = _lists(a, b)
    out = np.zeros(len(ids), np.int64)
    dense = size * DENSE > len(others)
    by_map = np.zeros(len(ids), bool)
    by_map[row[dense]] = True
    few = ~by_map[row]
    for key in _matches(row[few], first[few], size[few], b, same):
        rows, n = np.unique(_runs(key)[0] >> TOP_BIT, return_counts=True)
        out[rows] += n
    starts, which = np.unique(first[dense], return_inverse=True)
    place, bitmaps = b & PLACE, np.zeros((len(starts), -(-len(others) // 8)), np.uint8)
    for i, (start, n) in enumerate(zip(starts, size[dense][np.unique(which, return_index=True)[1]])):
        bits = np.zeros(len(others), bool)
        bits[place[start : start + n]] = True
        bitmaps[i] = np.packbits(bits)
    of_visit = np.full(len(row), -1)
    of_visit[dense] = which
    users = np.flatnonzero(by_map)
    for user, begin, end in zip(users, np.searchsorted(row, users), np.searchsorted(row, users, "right")):
        maps = of_visit[begin:end]
        bits = np.unpackbits(np.bitwise_or.reduce(bitmaps[maps[maps >= 0]], axis=0), count=len(others))
        for visit in begin + np.flatnonzero(maps < 0):
            bits[place[first[visit] : first[visit] + size[visit]]] = 1
        out[user] = np.count_nonzero(bits[user + 1 if same else 0 :])
    return out
