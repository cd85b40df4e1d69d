"""SimHash near-duplicates: exact search by radius in tiles of equal population counts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.llm.components import connected_components
from comanda.llm.text import LOWER, fresh, groups_of
from comanda.session import cut_lineage

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
BLOCKS = 4  # a tile holds the fingerprints with equal population counts in each 16-bit quarter
TILE_ROWS = 4096  # larger tiles are cut into chunks, and chunk is compared with chunk
GUEST_ROWS = 1 << 16  # more guests of a tile are cut into parts
PLACE_BITS = 21  # for the number of a chunk, and of a part


def fingerprint_of(text: str | None, width: int) -> int:
    """Majority of the bits of the XXH64 of all word shingles (A-Z in lower case), as unsigned 64 bits."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return 0
    if len(tokens) < width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)]
    else:
        line = b" ".join(tokens)
        ends = [e - 1 for e in accumulate(len(t) + 1 for t in tokens)]
        starts = [0] + [e + 1 for e in ends[:-1]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[width - 1:])]
    ones = np.zeros(64, np.int64)
    array = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(array), 65536):
        ones += np.unpackbits(array[at:at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint",
                 width: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with its 64-bit SimHash as a long. Null and empty texts have 0."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out_col, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            found = np.fromiter((fingerprint_of(t.as_py(), width) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, out_col])

    return docs.mapInArrow(add, schema)


def _roots(nodes: np.ndarray, homes: int, radius: int, inside: bool = True, tile: int = 1024) -> np.ndarray:
    """For each node the index of a linked node it hangs on, so that linked nodes share a tree.

    Homes are compared with each other (if ``inside``) and with the guests behind them, tile by tile; tile pairs whose
    total population counts lie further apart than the radius are skipped.
    """
    counts = np.bitwise_count(nodes).astype(np.int64)
    order = np.concatenate([np.argsort(counts[:homes], kind="stable"),
                            homes + np.argsort(counts[homes:], kind="stable")])
    nodes, counts = nodes[order], counts[order]
    root = np.arange(len(nodes))
    cuts = [*range(0, homes, tile), homes, *range(homes + tile, len(nodes), tile), len(nodes)]
    cuts = sorted(set(cuts))
    spans = list(zip(cuts, cuts[1:]))
    for i, (a, b) in enumerate(spans):
        if a >= homes:
            break
        for c, d in spans[i:]:
            if c < homes and not inside or counts[c] - counts[b - 1] > radius or counts[a] - counts[d - 1] > radius:
                continue
            near = np.bitwise_count(nodes[a:b, None] ^ nodes[None, c:d]) <= radius
            x, y = np.nonzero(near)
            x, y = x + a, y + c
            keep = x < y
            x, y = x[keep], y[keep]
            while len(x):  # merge the trees of linked nodes
                rx, ry = root[x], root[y]
                differ = rx != ry
                if not differ.any():
                    break
                x, y, rx, ry = x[differ], y[differ], rx[differ], ry[differ]
                np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
                while (root[root] != root).any():
                    root = root[root]
    out = np.empty(len(nodes), np.int64)
    out[order] = order[root]
    return out


def _dealt(distinct: DataFrame, radius: int) -> DataFrame:
    """(place, guest, fp): what is compared in one place, at most about TILE_ROWS homes with GUEST_ROWS guests.

    A tile's own fingerprints are cut into chunks by hash, its guests (visitors, and for a chunk the fingerprints of the
    chunks before it) into parts. Each chunk meets each part; with many guests a home is sent once for each part.
    """
    bits = 64 // BLOCKS
    step = 32
    count = [F.bit_count(F.shiftrightunsigned("fp", bits * i).bitwiseAND(F.lit((1 << bits) - 1))) for i in range(BLOCKS)]
    tile = sum((c * F.lit(step**i) for i, c in enumerate(count)), F.lit(0)).cast("int")
    homes = distinct.select("fp", tile.alias("tile"))
    moves = [d for d in product(range(-radius, radius + 1), repeat=BLOCKS) if sum(map(abs, d)) <= radius]
    shifts = sorted({sum(d * step**i for i, d in enumerate(m)) for m in moves})
    forward = F.explode(F.array(*(F.col("tile") + s for s in shifts if s > 0))).alias("tile")
    # one row per tile: at most 17^4 = 83,521 whatever the input, so it may be broadcast
    sizes = cut_lineage(homes.groupBy("tile").agg(F.count(F.lit(1)).alias("rows")))
    visitors = sizes.select(forward, "rows").groupBy("tile").agg(F.sum("rows").alias("visitors"))
    chunks = F.ceil(F.col("rows") / TILE_ROWS).cast("int")
    guests = F.coalesce("visitors", F.lit(0)) + F.when(chunks > 1, F.col("rows")).otherwise(0)
    tiles = F.broadcast(sizes.join(visitors, "tile", "left").select(
        "tile", chunks.alias("chunks"), F.greatest(F.lit(1), F.ceil(guests / GUEST_ROWS)).cast("int").alias("parts")))

    own = homes.join(tiles, "tile").withColumn("at", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    part = F.pmod(F.xxhash64("fp", F.lit("guest")), F.col("parts")).cast("int").alias("part")
    at_home = own.select(
        "fp", "tile", F.col("at").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("guest"))
    next_door = own.filter(F.col("at") + 1 < F.col("chunks")).select(
        "fp", "tile", F.explode(F.sequence(F.col("at") + 1, F.col("chunks") - 1)).alias("chunk"), part, F.lit(True).alias("guest"))
    visits = homes.select("fp", forward).join(tiles, "tile").select(
        "fp", "tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), part, F.lit(True).alias("guest"))
    place = F.col("tile").cast("long") * 2 ** (2 * PLACE_BITS) + F.col("chunk").cast("long") * 2**PLACE_BITS + F.col("part")
    dealt = at_home.unionByName(next_door).unionByName(visits).select(place.alias("place"), "guest", "fp")
    return dealt.repartition("place").sortWithinPartitions("place", "guest")


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) that join everything within ``radius`` bits.

    Two fingerprints within the radius differ by at most the radius in the sum of their quarters' population
    counts. So a fingerprint lives in the tile of its four counts and visits the (larger) neighbouring tiles. Each
    tile gives a forest over its linked nodes, never all pairs; no link is lost for connectivity.
    """
    dealt = _dealt(distinct, radius)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "place"):
            nodes = group.column("fp").to_numpy().astype(np.int64)
            homes_here = int((~group.column("guest").to_numpy()).sum())
            inside = group.column("place")[0].as_py() % (1 << PLACE_BITS) == 0  # homes meet each other once
            root = _roots(nodes.view(np.uint64), homes_here, radius, inside)
            linked = np.flatnonzero(root != np.arange(len(nodes)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], ["u", "v"])

    return dealt.mapInArrow(compare, "u long, v long")


def components(keyed: DataFrame, id_col: str, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for the fingerprints of ``keyed`` (fp, id_col) that are linked to another one.

    ``component_id`` is the smallest id of the component.
    """
    distinct = cut_lineage(keyed.groupBy("fp").agg(F.min(id_col).alias("_first")))
    roots = cut_lineage(connected_components(links(distinct, radius)))
    members = roots.join(distinct, roots["node"] == distinct["fp"]).select("node", "root", "_first")
    smallest = members.groupBy("root").agg(F.min("_first").alias("component_id"))
    linked = members.join(smallest, "root").select(F.col("node").alias("fp"), "root", "component_id")
    alone = distinct.join(roots, distinct["fp"] == roots["node"], "left_anti").select(
        "fp", F.col("fp").alias("root"), F.col("_first").alias("component_id"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: its id, fingerprint (16 hex digits) and component.

    Null and empty texts share fingerprint 0 and link like any other. A repeated row is repeated in the result. A
    null id belongs to its component but never names it (unless no row there has an id). Empty in, empty out; other
    columns don't matter.
    """
    plain = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    keyed = cut_lineage(fingerprints(plain, "_text", "fp", width).select("_id", "fp"))
    return keyed.join(components(keyed, "_id", radius), "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (of equal rows, one)."""
    fp, own, root, first_id = (fresh(docs, c) for c in ("fp", "class_fp", "class_root", "class_first"))
    keyed = cut_lineage(fingerprints(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", "fp", width).select("_id", "fp"))
    classes = components(keyed, "_id", radius).select(
        F.col("fp").alias(own), F.col("root").alias(root), F.col("component_id").alias(first_id))
    tagged = fingerprints(docs, text_col, fp, width)
    first = tagged.join(classes, (F.col(fp) == F.col(own)) & F.col(id_col).eqNullSafe(F.col(first_id)))
    return first.dropDuplicates([root]).select(*[F.col(f"`{c}`") for c in docs.columns])
