"""Shortest paths as rounds of joins; every round is checkpointed, and the loop ends when nothing improves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.money import units
from comanda.session import cut_lineage

ROUNDS_PER_CHECKPOINT = 4
UNKNOWN_KM = 999.0  # fixed value: the length of a way that does not exist
HOPS_SCHEMA = "route array<string>, legs_km array<double>, total_km double"
LIGHTEST_SCHEMA = "src string, dst string, km double, route array<string>, costs array<double>"


def both_ways(edges: DataFrame) -> DataFrame:
    """``edges(src, dst, km)`` usable in both directions; of parallel edges the shortest."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "km")
    return edges.select("src", "dst", "km").unionByName(back).groupBy("src", "dst").agg(F.min("km").alias("km"))


def fewest_hops(edges: DataFrame, start: str, end: str) -> DataFrame:
    """The path with the fewest edges: (route, legs_km, total_km); of equal paths the first by node names.

    Edges count in both directions. The search goes on from both ends, a level at a time from the end that has fewer
    nodes at its rim, until the rims meet, so it sees far fewer nodes than one from a single end. A level is a table of nodes,
    stored; next to it lie only itself, the level before and the one after, so no set of all seen nodes is kept, and the
    plan of a level is the same at any depth. The path is then walked over the levels, one node at a time. No row without
    a path.
    """
    edges = cut_lineage(both_ways(edges))
    spark = edges.sparkSession

    def node(name: str) -> DataFrame:
        return spark.createDataFrame([(name,)], "node string")

    def beyond(level: DataFrame, *nearer: DataFrame) -> DataFrame:
        out = level.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        for other in (level, *nearer):
            out = out.join(other, "node", "left_anti")
        return cut_lineage(out)

    levels, rims = ([node(start)], [node(end)]), [1, 1]
    met = levels[0][0] if start == end else None
    while met is None:
        side = 0 if rims[0] <= rims[1] else 1
        own, other = levels[side], levels[1 - side]
        own.append(beyond(own[-1], *own[-2:-1]))
        rims[side] = own[-1].count()
        if not rims[side]:
            return spark.createDataFrame([], HOPS_SCHEMA)
        found = own[-1].join(other[-1], "node", "left_semi")
        met = found if not found.isEmpty() else None

    # from the start, only what leads on to a meeting node
    ahead = [cut_lineage(met)]
    for level in reversed(levels[0][:-1]):
        toward = edges.join(ahead[0].select(F.col("node").alias("dst")), "dst", "left_semi").select(F.col("src").alias("node"))
        ahead.insert(0, cut_lineage(level.join(toward, "node", "left_semi")))
    route, legs = [start], []
    for level in [*ahead[1:], *reversed(levels[1][:-1])]:
        step = edges.filter(F.col("src") == route[-1]).join(level.select(F.col("node").alias("dst")), "dst", "left_semi")
        step = step.orderBy("dst").select("dst", "km").first()
        route.append(step["dst"])
        legs.append(step["km"])
    return spark.createDataFrame([(route, legs, sum(legs, 0.0))], HOPS_SCHEMA)


def settled(edges: DataFrame, sources: DataFrame, until: str | None = None) -> DataFrame:
    """(src, dst, length, hops) of the shortest path from each of ``sources(src)`` to every node it can reach.

    Lengths are whole hundredths, so the result does not depend on the order of the legs; of equally long paths the fewest
    hops count. By buckets of length (delta stepping): only nodes of the nearest bucket that a round made shorter are
    extended, so a node far out is not extended again and again while the near ones still change. With ``until`` the search
    ends when that node's length is final; others may then be missing or longer than need be.
    """
    legs = cut_lineage(edges.select(F.col("src").alias("via"), F.col("dst").alias("next"), units("km").alias("leg")))
    width = max(1, int(legs.agg(F.avg("leg")).first()[0] or 1))  # of a bucket
    zero = F.lit(0).cast("bigint")
    known = cut_lineage(sources.select("src", F.col("src").alias("dst"), zero.alias("length"), zero.alias("hops")).distinct().withColumn(
        "open", F.lit(True)))
    while True:
        nearest = F.min(F.when(F.col("open"), F.col("length")))
        final = F.max(F.when(F.col("dst") == until, F.col("length"))) if until is not None else F.lit(None).cast("bigint")
        low, goal = known.agg(nearest, final).first()
        if low is None or (goal is not None and low >= goal):
            return known.drop("open")
        now = F.col("open") & (F.col("length") < (low // width + 1) * width)
        further = known.filter(now).join(legs, F.col("dst") == F.col("via")).groupBy("src", F.col("next").alias("dst")).agg(
            F.min(F.struct((F.col("length") + F.col("leg")).alias("length"), (F.col("hops") + 1).alias("hops"))).alias("found"))
        own = F.struct("length", "hops")
        better = F.col("found").isNotNull() & (F.col("length").isNull() | (F.col("found") < own))
        best = F.when(better, F.col("found")).otherwise(own)
        known = cut_lineage(known.join(further, ["src", "dst"], "full").select(
            "src", "dst", best.getField("length").alias("length"), best.getField("hops").alias("hops"),
            (better | (F.coalesce("open", F.lit(False)) & ~F.coalesce(now, F.lit(False)))).alias("open")))


def lightest_path(edges: DataFrame, start: str, end: str) -> DataFrame:
    """The shortest path by km from ``start`` to ``end``: (src, dst, km, route, costs: running km at each node).

    Of equally long paths the one with fewer nodes counts, then the first by names. Nodes get their length to the end, in
    buckets, until the start's is final; the path then follows the legs that lose exactly that length. No row without a path.
    """
    spark = edges.sparkSession
    edges = cut_lineage(edges.groupBy("src", "dst").agg(F.min("km").alias("km")))
    turned = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "km")
    to_end = settled(turned, spark.createDataFrame([(end,)], "src string"), until=start).select(
        F.col("dst").alias("node"), "length", "hops")
    here = to_end.filter(F.col("node") == start).first()
    if here is None:
        return spark.createDataFrame([], LIGHTEST_SCHEMA)
    total, route, costs = here["length"], [start], [0.0]
    while here["hops"]:
        step = edges.filter(F.col("src") == here["node"]).join(to_end, F.col("dst") == F.col("node")).filter(
            (units("km") + F.col("length") == here["length"]) & (F.col("hops") == here["hops"] - 1))
        here = step.orderBy("node").select("node", "length", "hops").first()
        route.append(here["node"])
        costs.append((total - here["length"]) / 100)
    return spark.createDataFrame([(start, end, total / 100, route, costs)], LIGHTEST_SCHEMA)


def lightest_paths(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Shortest path by km from each of ``sources(src)`` to every node it can reach.

    Columns src, dst, km, route, costs (running km at each node). Of equally long paths the one with fewer nodes
    counts, then the first by names. Weights must not be negative. A round extends every path by one edge, or by
    none, and keeps the best per pair; a few rounds form one job.
    """
    no_edge = F.lit(None).cast("string")
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).union(sources.select("src")).distinct()
    steps = cut_lineage(
        edges.select(F.col("src").alias("node"), F.col("dst").alias("next"), F.col("km").alias("leg"))
        .unionByName(nodes.select("node", no_edge.alias("next"), F.lit(0.0).alias("leg")))
    )
    moved = F.col("next").isNotNull()
    km = F.col("km") + F.col("leg")
    step = F.struct(
        km.alias("km"),
        (F.col("hops") + F.when(moved, 1).otherwise(0)).alias("hops"),
        F.when(moved, F.array_append("route", F.col("next"))).otherwise(F.col("route")).alias("route"),
        F.when(moved, F.array_append("costs", km)).otherwise(F.col("costs")).alias("costs"),
        (F.col("is_new") | moved).alias("is_new"),
    )
    best = sources.select(
        "src", F.col("src").alias("dst"), F.lit(0.0).alias("km"), F.lit(0).alias("hops"),
        F.array("src").alias("route"), F.array(F.lit(0.0)).alias("costs"),
    )
    improved = True
    while improved:
        state = best.withColumn("is_new", F.lit(False))
        for _ in range(ROUNDS_PER_CHECKPOINT):
            state = (
                state.join(steps, F.col("dst") == F.col("node"))
                .groupBy("src", F.coalesce("next", "dst").alias("dst"))
                .agg(F.min(step).alias("path"))
                .select("src", "dst", "path.*")
            )
        state = cut_lineage(state)
        best = state.drop("is_new")
        improved = not state.filter("is_new").isEmpty()
    return best.drop("hops")


def distances_from(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """(src, dst, km) of the shortest path from each of ``sources(src)`` to every node; edges have km with two decimals."""
    return settled(edges, sources).select("src", "dst", (F.col("length") / 100).alias("km"))


def zone_distance(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """(from_zone, to_zone, distance_km) of the asked ``pairs``: the shortest path, 0 inside a zone, ``UNKNOWN_KM``
    without a path. Paths are searched from the zones that a pair starts from only."""
    asked = pairs.select("from_zone", "to_zone").distinct()
    paths = distances_from(asked.select(F.col("from_zone").alias("src")), edges).select(
        F.col("src").alias("from_zone"), F.col("dst").alias("to_zone"), F.col("km").alias("path_km"))
    km = F.when(F.col("from_zone") == F.col("to_zone"), 0.0).otherwise(F.coalesce("path_km", F.lit(UNKNOWN_KM)))
    return asked.join(paths, ["from_zone", "to_zone"], "left").select("from_zone", "to_zone", km.alias("distance_km"))
