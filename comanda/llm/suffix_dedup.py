"""Removal of passages that an earlier document has, by sorting the suffixes that can be equal.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a smaller id. To find those strings
without sorting every suffix of the corpus, each string is filed under the smallest hash of its ``KMER``-byte pieces:
equal strings share it, and neighbouring strings mostly do, so a document is a sequence of runs, one for some seventeen
bytes. What is dealt to shards is one short entry for each run: the piece's hash, a hash of the run's bytes, its place.

* Runs with equal bytes are settled by comparing ids, first within a task, so that copies are not sent at all.
* Different runs under one hash (the edges of repeated passages) are fetched from their texts, and all their suffixes
  are put in order by deep-shallow sorting (Manzini and Ferragina, 2004): multikey quicksort to a shallow depth, blind
  tries for the groups that are still equal there. Equal strings then lie side by side.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.llm.text import groups_of
from comanda.session import ensure_checkpoint_dir

LENGTH = 50
KMER = 20
SHALLOW = 24  # bytes that multikey quicksort looks at, in symbols of eight
BLOCK = 1 << 20  # bytes of text whose runs are found at once
COMBINE_BYTES = 12 << 20  # bytes of text whose equal runs are combined before they are sent
SHARD_BYTES = 16 << 20  # bytes of text for each shard of runs
LONGEST_RUN = 50_000
CROWD = 20_000  # different runs under one hash from which their strings are dealt one by one
LAST_ID = (1 << 63) - 1  # stands for a null id: after all others

_A, _B, _C, _D = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_POWER = 0x2545F4914F6CDD1D


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Runs of a block of text: place, length (number of strings), hash of the smallest piece, hash of the bytes."""

    def __init__(self) -> None:
        self.up = _powers(_POWER, BLOCK + LENGTH + 1)
        self.down = _powers(pow(_POWER, -1, 1 << 64), BLOCK + LENGTH + 1)

    def find(self, data: bytes, valid: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
        """``valid``: places where a string starts; ``text``: the text of each. ``data`` is padded by eight bytes."""
        size = len(data) - 8
        word = np.ndarray((size,), "<u8", data, 0, (1,)).copy()
        piece = self._pieces(word)
        window = LENGTH - KMER + 1
        least, span = piece, 1
        while 2 * span <= window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < window:
            least = np.minimum(least[:len(least) - (window - span)], least[window - span:])
        key = least[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (key[1:] != key[:-1]) | (valid[1:] != valid[:-1] + 1) | (text[1:] != text[:-1])
        cut = np.flatnonzero(new)
        length = np.diff(np.append(cut, len(valid)))
        if len(length) and length.max() > LONGEST_RUN:
            cut = np.unique(np.concatenate([cut, *(np.arange(c, c + n, LONGEST_RUN) for c, n in zip(cut, length) if n > LONGEST_RUN)]))
            length = np.diff(np.append(cut, len(valid)))
        first = valid[cut]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(word) * self.up[:size], dtype=np.uint64)])
        # the smallest of many hashes is small: mixed again, its upper bits deal evenly
        content = (sums[first + length + LENGTH - 8] - sums[first]) * self.down[first] + length.astype(np.uint64) * _D
        return first, length.astype(np.int32), text[cut].astype(np.int32), _mix(key[cut] * _D), _mix(content)

    @staticmethod
    def _pieces(word: np.ndarray) -> np.ndarray:
        """Hash of the KMER bytes from each place: of three words, the last of which overlaps."""
        n = len(word) - (KMER - 8)
        x = word[:n] * _A + word[8:8 + n] * _D
        return _mix(_mix(x) + word[KMER - 8:KMER - 8 + n])


def _texts(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, memoryview]:
    """Offsets and bytes of a text column without nulls."""
    column = batch.column(batch.schema.get_field_index(name))
    column = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = memoryview(column.buffers()[2] or b"")
    return offsets, data


def entries(docs: DataFrame, bits: int) -> DataFrame:
    """Rows with the runs of some texts that fall to a shard. Rows with a negative shard hold the strings of a document
    (id, hash) that are settled already, as ranges in ``place``."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs()
        held: list[tuple[np.ndarray, ...]] = []
        ids: list[np.ndarray] = []
        hashes: list[np.ndarray] = []
        texts = volume = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:  # no text is as long as a string
                return
            own_ids, own_hashes = np.concatenate(ids), np.concatenate(hashes)
            first, length, owner, key, content = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((own_ids[owner], content, key))
            first, length, owner, key, content = (x[order] for x in (first, length, owner, key, content))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
            smallest = own_ids[owner][np.flatnonzero(new)[np.cumsum(new) - 1]]
            done = own_ids[owner] > smallest
            yield from _settled(own_ids, own_hashes, owner[done], first[done], length[done], 1 << bits)
            first, length, owner, key, content = (x[~done] for x in (first, length, owner, key, content))
            shard = (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
            by_place = np.lexsort((first, owner, shard))
            cuts = np.searchsorted(shard[by_place], np.arange((1 << bits) + 1))
            rows = []
            for s in range(1 << bits):
                at = by_place[cuts[s]:cuts[s + 1]]
                if len(at):
                    used, number = np.unique(owner[at], return_inverse=True)
                    low = lambda x, n: x[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes()
                    rows.append((s, own_ids[used].tobytes(), own_hashes[used].astype(np.uint32).tobytes(), number.astype(np.uint16).tobytes(),
                                 low(key, 4), low(content, 6), (first[at] & 0xFFFF).astype(np.uint16).tobytes()
                                 + (first[at] >> 16).astype(np.uint32).tobytes(), length[at].astype(np.uint16).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
                 *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 8))], _ENTRY)

        for batch in batches:
            offsets, data = _texts(batch, "text")
            for a in range(0, batch.num_rows, 10_000):
                b = min(a + 10_000, batch.num_rows)
                while a < b:
                    # texts up to the bound of what is combined; one at least
                    c = max(a + 1, int(np.searchsorted(offsets[:b + 1], offsets[a] + COMBINE_BYTES, "right")) - 1)
                    c = min(c, b)
                    if texts and (texts + c - a > 60_000 or volume + offsets[c] - offsets[a] > COMBINE_BYTES):
                        yield from flush()
                        held, ids, hashes, texts, volume = [], [], [], 0, 0
                    held += _runs_of(runs, data, offsets[a:c + 1], texts)
                    ids.append(_numbers(batch, "id", a, c))
                    hashes.append(_numbers(batch, "hash", a, c))
                    texts += c - a
                    volume += offsets[c] - offsets[a]
                    a = c
        if texts:
            yield from flush()

    return docs.mapInArrow(send, ", ".join(f"{n} {t}" for n, t in zip(_ENTRY, _ENTRY_TYPES)))


_ENTRY = ["shard", "id", "hash", "ids", "hashes", "owner", "key", "content", "place", "length"]
_ENTRY_TYPES = ["int", "long", "long", *["binary"] * 7]


def _numbers(batch: pa.RecordBatch, name: str, a: int, c: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).slice(a, c - a).to_numpy().astype(np.int64)


def _runs_of(runs: Runs, data: memoryview, offsets: np.ndarray, number: int) -> list[tuple[np.ndarray, ...]]:
    """Runs of consecutive texts in blocks, with places within their texts and text numbers from ``number``."""
    out = []
    begin, end = int(offsets[0]), int(offsets[-1])
    for at in range(begin, end, BLOCK):
        stop = min(at + BLOCK, end)
        first = int(np.searchsorted(offsets, at, "right")) - 1
        last = int(np.searchsorted(offsets, stop, "left"))
        starts = np.maximum(offsets[first:last], at)
        ends = np.minimum(offsets[first + 1:last + 1] - LENGTH + 1, stop)
        count = np.maximum(ends - starts, 0)
        if not count.sum():
            continue
        text = np.repeat(np.arange(first, last), count)
        valid = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(starts, count) - at
        block = bytes(data[at:min(stop + LENGTH, end)]) + b"\0" * (LENGTH + 8)
        place, length, owner, key, content = runs.find(block[:stop - at + LENGTH + 8], valid, text)
        out.append((place + at - offsets[owner], length, (owner + number).astype(np.int32), key, content))
    return out


def _settled(ids, hashes, owner, first, length, shards: int) -> Iterator[pa.RecordBatch]:
    """Ranges of strings that an earlier document has, one row for each document."""
    if not len(owner):
        return
    order = np.lexsort((first, owner))
    owner, pairs = owner[order], np.stack([first[order], length[order]], 1).astype(np.int64)
    used, cuts = np.unique(owner, return_index=True)
    ranges = [pairs[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(owner)))]
    none = lambda kind: pa.nulls(len(used), kind)
    yield pa.RecordBatch.from_arrays([
        pa.array((-1 - hashes[used] % shards).astype(np.int32)), pa.array(ids[used]), pa.array(hashes[used]), none(pa.binary()), none(pa.binary()), none(pa.binary()),
        none(pa.binary()), none(pa.binary()), pa.array(ranges, pa.binary()), none(pa.binary())], _ENTRY)


_FOUND = ["id", "hash", "kind", "ranges"]


def settle(dealt: DataFrame, bits: int) -> DataFrame:
    """(id, hash, kind, ranges): strings found in earlier documents ('have': pairs of place and number), and runs whose
    bytes must be compared ('want': triples of place, number and group, negative for a crowd)."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "shard"):
            column = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in group.column(name)]
            shard = group.column("shard")[0].as_py()
            if shard < 0:
                for part in group.select(["id", "hash", "place"]).to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(["have"] * len(part)), part.column(2)], _FOUND)
                continue
            ids, owners = column("ids", np.int64), column("owner", np.uint16)
            shift = np.cumsum([0, *(len(x) for x in ids)])[:-1]
            ids, hashes = np.concatenate(ids), np.concatenate(column("hashes", np.uint32)).astype(np.int64)
            owner = np.concatenate([o.astype(np.int64) + s for o, s in zip(owners, shift)])
            key = np.concatenate(column("key", np.uint32)).astype(np.int64)
            low = np.concatenate([c.reshape(-1, 6) for c in column("content", np.uint8)])
            content = np.zeros((len(low), 8), np.uint8)
            content[:, :6] = low
            content = content.view(np.int64).ravel()
            first = np.concatenate([
                np.frombuffer(p, np.uint16, n).astype(np.int64) + (np.frombuffer(p, np.uint32, n, 2 * n).astype(np.int64) << 16)
                for p, n in zip((x.as_py() for x in group.column("place")), (len(o) for o in owners))])
            length = np.concatenate(column("length", np.uint16)).astype(np.int64)

            order = np.lexsort((ids[owner], content, key))
            owner, key, content, first, length = (x[order] for x in (owner, key, content, first, length))
            who = ids[owner]
            new_key = np.ones(len(key), bool)
            new_key[1:] = key[1:] != key[:-1]
            new = new_key.copy()
            new[1:] |= content[1:] != content[:-1]
            have = who > who[np.flatnonzero(new)[np.cumsum(new) - 1]]
            number = np.cumsum(new_key) - 1
            kinds = np.bincount(number, new).astype(np.int64)
            starts = np.flatnonzero(new_key)
            mixed = (kinds > 1) & (np.maximum.reduceat(who, starts) > np.minimum.reduceat(who, starts))
            want = mixed[number] & ~have
            crowd = want & (kinds[number] > CROWD)
            name = (np.int64(shard) << 32) | key
            name[crowd] = -1 - name[crowd]
            for kind, chosen in (("have", have), ("want", want)):
                at = np.flatnonzero(chosen)
                if not len(at):
                    continue
                at = at[np.argsort(owner[at], kind="stable")]
                rows = np.stack([first[at], length[at], name[at]], 1)
                used, cuts = np.unique(owner[at], return_index=True)
                parts = [rows[a:b, :2 if kind == "have" else 3].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(at)))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[used]), pa.array(hashes[used]), pa.array([kind] * len(used)), pa.array(parts, pa.binary())], _FOUND)

    return dealt.repartition(1 << bits, "shard").sortWithinPartitions("shard").mapInArrow(
        compare, "id long, hash long, kind string, ranges binary")


class BlindTrie:
    """Strings of one length in order, by the bytes where they part; the rest is looked at once for each string."""

    def __init__(self, first: bytes):
        self.root: list | bytes = first

    def add(self, text: bytes) -> None:
        # blind descent to some leaf
        node = self.root
        while isinstance(node, list):
            children = node[1]
            node = children.get(text[node[0]]) or next(iter(children.values()))
        if node == text:
            return
        a, b = int.from_bytes(node), int.from_bytes(text)
        depth = len(text) - ((a ^ b).bit_length() + 7) // 8  # the first byte where they part
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            parent, node = node, node[1][text[node[0]]]
        if isinstance(node, list) and node[0] == depth:
            node[1][text[depth]] = text
            return
        leaf = node
        while isinstance(leaf, list):
            leaf = next(iter(leaf[1].values()))
        split = [depth, {leaf[depth]: node, text[depth]: text}]
        if parent is None:
            self.root = split
        else:
            parent[1][text[parent[0]]] = split

    def ordered(self) -> Iterator[bytes]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                yield node


def deep_shallow(data: bytes, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings of LENGTH bytes at ``starts`` by group and bytes, and the rank of each among the distinct
    ones (in that order; equal strings of a group share it)."""
    symbol = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
    order = np.argsort(group, kind="stable")
    _, rank = np.unique(group[order], return_inverse=True)
    # shallow: groups that are still equal are split by their next symbol, all at once
    for depth in range(0, SHALLOW, 8):
        size = np.bincount(rank)
        still = np.flatnonzero(size[rank] > 1)
        if not len(still):
            break
        value = symbol[starts[order[still]] + depth].astype(np.uint64)
        by = np.lexsort((value, rank[still]))
        order[still], value = order[still[by]], value[by]
        new = np.zeros(len(order), bool)
        new[1:] = rank[1:] != rank[:-1]
        inner = np.zeros(len(still), bool)
        inner[1:] = (value[1:] != value[:-1])
        new[still] |= inner & ~np.concatenate([[True], np.diff(still) != 1])
        rank = np.cumsum(new)
    # deep: what is equal so far is ordered by blind tries, unless it is equal to the end
    size = np.bincount(rank)
    first = np.cumsum(size) - size
    open_ = np.flatnonzero(size > 1)
    rest = [SHALLOW + 8 * i for i in range((LENGTH - SHALLOW) // 8)] + [LENGTH - 8]
    still = np.flatnonzero(size[rank] > 1)
    differ = np.zeros(len(size), bool)
    for depth in rest:
        value = symbol[starts[order[still]] + depth]
        lead = symbol[starts[order[first[rank[still]]]] + depth]
        differ[rank[still[value != lead]]] = True
    extra = np.zeros(len(order), np.int64)
    for g in open_[differ[open_]]:
        members = order[first[g]:first[g] + size[g]]
        tails = [data[s + SHALLOW:s + LENGTH] for s in starts[members].tolist()]
        distinct = iter(dict.fromkeys(tails))
        trie = BlindTrie(next(distinct))
        for tail in distinct:
            trie.add(tail)
        place = {tail: i for i, tail in enumerate(trie.ordered())}
        at = np.fromiter((place[t] for t in tails), np.int64, len(tails))
        by = np.argsort(at, kind="stable")
        order[first[g]:first[g] + size[g]] = members[by]
        extra[first[g]:first[g] + size[g]] = at[by]
    new = np.zeros(len(order), bool)
    new[1:] = (rank[1:] != rank[:-1]) | (extra[1:] != extra[:-1])
    return order, np.cumsum(new)


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(group, id, hash, place, bytes) of the runs that ``wanted`` (id, hash, ranges: list) names."""
    joined = docs.join(wanted, (docs["id"] == wanted["_id"]) & (docs["hash"] == wanted["_hash"])).select(
        "id", "hash", "text", "asked")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                out: list[list] = [[], [], [], [], []]
                for i, h, text, asked in zip(*(part.column(k) for k in range(4))):
                    data = text.as_py().encode("utf-8", "surrogatepass")
                    rows = np.frombuffer(b"".join(asked.as_py()), np.int64).reshape(-1, 3)
                    for first, length, group in rows.tolist():
                        out[0].append(group)
                        out[3].append(first)
                        out[4].append(data[first:first + length + LENGTH - 1])
                    out[1] += [i.as_py()] * len(rows)
                    out[2] += [h.as_py()] * len(rows)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in out[:4]), pa.array(out[4], pa.binary())],
                    ["group", "id", "hash", "place", "bytes"])

    return joined.mapInArrow(cut, "group long, id long, hash long, place long, bytes binary")


def _sorted_out(pieces: DataFrame) -> DataFrame:
    """(id, hash, ranges): strings of the pieces that an earlier document has under the same group."""
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        volume = 0
        for group in groups_of(batches, "group"):
            held.append(group)
            volume += group.num_rows
            if volume > 20_000:  # whole groups
                yield from _compare(pa.concat_tables(held))
                held, volume = [], 0
        if held:
            yield from _compare(pa.concat_tables(held))

    return pieces.repartition("group").sortWithinPartitions("group").mapInArrow(sort, "id long, hash long, ranges binary")


def _compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    ids, hashes, groups, places = (rows.column(c).to_numpy() for c in ("id", "hash", "group", "place"))
    parts = rows.column("bytes").to_pylist()
    size = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    begin = np.cumsum(size) - size
    count = size - LENGTH + 1
    piece = np.repeat(np.arange(len(parts)), count)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    if not len(piece):
        return
    order, rank = deep_shallow(b"".join(parts) + b"\0" * 8, begin[piece] + offset, groups[piece])
    who = ids[piece[order]]
    smallest = np.full(rank[-1] + 1, LAST_ID)
    np.minimum.at(smallest, rank, who)
    hit = order[who > smallest[rank]]
    if not len(hit):
        return
    hit.sort()
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (piece[hit[1:]] != piece[hit[:-1]])
    cut = np.flatnonzero(new)
    length = np.diff(np.append(cut, len(hit)))
    at = piece[hit[cut]]
    first = places[at] + offset[hit[cut]]
    yield pa.RecordBatch.from_arrays([
        pa.array(ids[at]), pa.array(hashes[at]),
        pa.array([x.tobytes() for x in np.stack([first, length], 1).astype(np.int64)], pa.binary())], ["id", "hash", "ranges"])


def _one_by_one(pieces: DataFrame) -> DataFrame:
    """The same for crowds: their strings as rows, the smallest id of each string combined before it is dealt."""
    strings = pieces.withColumn("at", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - LENGTH))).select(
        "id", "hash", (F.col("place") + F.col("at")).alias("place"),
        F.substring(F.col("bytes"), F.col("at") + 1, F.lit(LENGTH)).alias("string"))
    smallest = strings.groupBy(F.col("string").alias("_string")).agg(F.min("id").alias("_smallest"))
    found = strings.join(smallest, F.col("string") == F.col("_string")).filter("id > _smallest")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.stack([batch.column(2).to_numpy(), np.ones(batch.num_rows, np.int64)], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in pairs], pa.binary())], ["id", "hash", "ranges"])

    return found.select("id", "hash", "place").mapInArrow(pack, "id long, hash long, ranges binary")


def _rest(text: str, ranges: list[bytes]) -> tuple[bytes, int, int]:
    """The bytes that stay, the number of removed ones, and of their runs."""
    data = text.encode("utf-8", "surrogatepass")
    if not ranges:
        return data, 0, 0
    pairs = np.frombuffer(b"".join(ranges), np.int64).reshape(-1, 2)
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, pairs[:, 0], 1)
    np.add.at(change, pairs[:, 0] + pairs[:, 1] + LENGTH - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each row, and the remaining bytes as ``kept`` if asked for.

    Null and empty texts have no bytes; texts shorter than a string lose nothing. Rows with one id don't count as
    earlier than each other, so repeated rows stay alike; a null id is later than all others (the largest long means
    the same). Ids must be integers. Other columns don't matter; an empty table gives an empty result.
    """
    plain = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash"),  # rows of one id
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    volume = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, volume / SHARD_BYTES)))))
    path = f"{ensure_checkpoint_dir(docs.sparkSession)}/suffix-{uuid.uuid4().hex}"
    settle(entries(plain, bits), bits).write.option("compression", "zstd").parquet(path)
    found = docs.sparkSession.read.parquet(path)

    # both joins deal the texts by (id, hash): Spark does it once
    wanted = found.filter("kind = 'want'").groupBy(F.col("id").alias("_id"), F.col("hash").alias("_hash")).agg(
        F.collect_list("ranges").alias("asked"))
    pieces = _fetched(plain, wanted)
    gone = found.filter("kind = 'have'").select("id", "hash", "ranges").unionByName(_sorted_out(pieces.filter("group >= 0")))
    if _has_crowds(found):
        gone = gone.unionByName(_one_by_one(pieces.filter("group < 0")))
    gone = gone.groupBy(F.col("id").alias("_id"), F.col("hash").alias("_hash")).agg(F.collect_list("ranges").alias("gone"))
    joined = plain.join(gone, (plain["id"] == gone["_id"]) & (plain["hash"] == gone["_hash"]), "left").select(
        "id", "text", "gone")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, ranges in zip(batch.column(1), batch.column(2)):
                rest, removed, spans = _rest(text.as_py(), ranges.as_py())
                out[0].append(len(rest) + removed)
                out[1].append(removed)
                out[2].append(spans)
                out[3].append(hashlib.sha256(rest).hexdigest())
                out[4].append(rest if keep_bytes else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string()),
                 *([pa.array(out[4], pa.binary())] if keep_bytes else [])], names)

    schema = T.StructType([
        T.StructField("id", T.LongType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
        T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept", T.BinaryType())] if keep_bytes else [])])
    names = schema.names
    key = F.when(F.col("id") != LAST_ID, F.col("id")).cast(docs.schema[id_col].dataType)
    return joined.mapInArrow(cut, schema).select(key.alias(id_col), *names[1:])


def _has_crowds(found: DataFrame) -> bool:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowds = 0
        for batch in batches:
            crowds += sum(int((np.frombuffer(r.as_buffer(), np.int64)[2::3] < 0).sum()) for r in batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array([crowds])], ["crowds"])

    return bool(found.filter("kind = 'want'").select("ranges").mapInArrow(look, "crowds long").agg(F.sum("crowds")).first()[0])
