"""Recommendations between users as merged edges: one edge for a pair, however many restaurants the two share.

The pairs grow with the square of a restaurant's visitors, so they are never moved. What is asked about them is found where two
blocks of users meet (``visitors``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.operators import visitors
from comanda.session import cut_lineage

PAIRS = "from_user long, to_user long, shared long"


def degrees(visits: DataFrame) -> DataFrame:
    """(user_id, recommends): how many users with larger ids share a restaurant with the user, each counted once.

    ``visits`` has distinct (user_id, via_restaurant). Every two blocks of users tell how many users of the second each
    user of the first knows; these counts are added up. Who knows nobody there is told by the block with itself only.
    """
    blocks = visitors.blocks(cut_lineage(visits.select("user_id", "via_restaurant")))

    def ask(lo: int, hi: int, one: tuple, two: tuple) -> Iterator[dict]:
        n = visitors.known(one, two, lo == hi)
        told = n > 0 if lo < hi else np.ones(len(n), bool)
        yield {"user_id": one[0][told], "n": n[told]}

    counts = visitors.over_pairs(blocks, ask, "user_id long, n long")
    return counts.groupBy("user_id").agg(F.sum("n").alias("recommends"))


def _shared(visits: DataFrame, min_shared: int, best: int | None = None) -> DataFrame:
    blocks = visitors.blocks(cut_lineage(visits.select("user_id", "via_restaurant")), min_shared - 1)

    def ask(lo: int, hi: int, one: tuple, two: tuple) -> Iterator[dict]:
        for row, other, shared in visitors.sharing(one, two, lo == hi, min_shared, best):
            yield {"from_user": one[0][row], "to_user": two[0][other], "shared": shared}

    return visitors.over_pairs(blocks, ask, PAIRS)


def sharing(visits: DataFrame, min_shared: int = 2) -> DataFrame:
    """(from_user, to_user, shared): pairs, smaller id first, that have at least ``min_shared`` restaurants in common.

    Two users share n restaurants only if one of these is not among the n-1 most visited of both: matches at a restaurant
    that is among them for both sides are left out before pairs are formed, and counted from the few that each side carries
    along. So a restaurant that is everybody's most visited makes no pair at all, and exact counts need no second look.
    """
    return _shared(visits, min_shared)


def top_recommendations(visits: DataFrame, min_shared: int = 2, best: int = 5) -> DataFrame:
    """(from_user, to_user, shared, place): for each user the ``best`` it shares most restaurants with, at least
    ``min_shared``; ties by id. A user recommends those with larger ids. Cut to the best before rows are moved."""
    most = W.partitionBy("from_user").orderBy(F.desc("shared"), "to_user")
    return _shared(visits, min_shared, best).withColumn("place", F.row_number().over(most)).filter(F.col("place") <= best)
