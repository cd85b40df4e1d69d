"""N-gram scoring with a log-frequency Bloom filter.

Texts become chunks: one row for some megabytes of text, with the hashes of its distinct words and its tokens as
numbers of those. Chunks are written once. What travels for counting are a chunk's distinct words and n-grams with their
counts, dealt to shards by hash: a word that is everywhere is one entry per chunk, so no key is hot, and a shard never
holds more than its part of the distinct entries. Exact counts of the words go back to the chunks that asked.

The model is a log-frequency Bloom filter (Talbot and Osborne, 2007): an n-gram with count c is stored once for every
level 1..1 + floor(log2 c), and its count is read back by probing level after level until one is missing. The filter
grows with the corpus, so it is not broadcast: each shard makes the segment for its bigrams, with room for all of them,
and answers the chunks that asked, as with the words. Words need no filter, their counts are exact.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.llm.text import LOWER, groups_of
from comanda.session import ensure_checkpoint_dir

CHUNK_BYTES = 8 << 20  # of text in a chunk
SHARD_BYTES = 16 << 20  # of text for each shard of the counts
BITS_PER_ENTRY = 7.2  # with four probes about 3 % of unknown entries seem known
PROBES = 4
PRIOR = 10.0  # weight of the unigram probability in a bigram's
MAX_LEVEL = 48
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))  # no word has white space

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _bigram(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(before * _A + word)


def _training(doc_id: object) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 != 1


def _chunk(ids: list, texts: list[str | None]) -> dict:
    """Distinct words (hashes, with their training counts) and the tokens of some texts."""
    codes: dict[bytes, int] = {}
    number = codes.setdefault
    tokens: list[int] = []
    sizes = []
    for text in texts:
        found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
        tokens += [number(w, len(codes)) for w in found]
        sizes.append(len(found) + 1)
        tokens.append(number(b"\n", len(codes)))
    train = np.fromiter((_training(i) for i in ids), bool, len(ids))
    token_codes = np.array(tokens, np.int32)
    counts = np.bincount(token_codes[np.repeat(train, sizes)], minlength=len(codes))
    words = np.fromiter((xxhash.xxh64_intdigest(w) for w in codes), np.uint64, len(codes))
    return {
        "ids": ids, "words": words.tobytes(), "counts": counts.astype(np.int64).tobytes(),
        "sizes": np.array(sizes, np.int32).tobytes(), "train": train.tobytes(), "tokens": token_codes.tobytes(),
    }


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder: one attempt of each task counts, and lost executors don't matter to readers."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("chunk", T.StringType()), T.StructField("ids", T.ArrayType(id_type)),
        *(T.StructField(c, T.BinaryType()) for c in ("words", "counts", "sizes", "train", "tokens"))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list = []
        held = 0

        def flush() -> pa.RecordBatch:
            row = {"chunk": uuid.uuid4().hex, **_chunk(ids, texts)}
            id_list = pa.array([row.pop("ids")], pa.list_(id_arrow))
            return pa.RecordBatch.from_arrays(
                [pa.array([row["chunk"]]), id_list, *(pa.array([row[c]], pa.binary()) for c in (
                    "words", "counts", "sizes", "train", "tokens"))],
                ["chunk", "ids", "words", "counts", "sizes", "train", "tokens"])

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                ids.append(i)
                texts.append(text)
                held += len(text or "") + 64
                if held >= CHUNK_BYTES:
                    yield flush()
                    ids, texts, held = [], [], 0
        if ids:
            yield flush()

    return docs.select(id_col, text_col).mapInArrow(build, schema)


def _deal(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by shard (the upper bits of a hash), and the first place of each shard."""
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange((1 << bits) + 1))


def _column(batch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def word_counts(stored: DataFrame, bits: int) -> DataFrame:
    """Exact training counts of each chunk's words: (chunk, shard, counts in the chunk's order, n, v).

    The rows with a null chunk hold the shard's training tokens ``n`` and distinct training words ``v``.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, counts in zip(*(_column(batch, c) for c in ("chunk", "words", "counts"))):
                words = np.frombuffer(words.as_buffer(), np.uint64)
                counts = np.frombuffer(counts.as_buffer(), np.int64)
                order, first = _deal(words, bits)
                rows = [(s, order[first[s]:first[s + 1]]) for s in range(1 << bits) if first[s] < first[s + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([s for s, _ in rows], pa.int32()), pa.array([chunk.as_py()] * len(rows)),
                    pa.array([words[at].tobytes() for _, at in rows], pa.binary()),
                    pa.array([counts[at].astype(np.int32).tobytes() for _, at in rows], pa.binary()),
                ], ["shard", "chunk", "words", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "shard"):
            parts = [np.frombuffer(w.as_buffer(), np.uint64) for w in group.column("words")]
            own = np.concatenate([np.frombuffer(c.as_buffer(), np.int32) for c in group.column("counts")])
            words, place = np.unique(np.concatenate(parts), return_inverse=True)
            total = np.bincount(place, own, len(words)).astype(np.int64)
            answers = np.split(total[place], np.cumsum([len(p) for p in parts])[:-1])
            shard = group.column("shard")[0].as_py()
            yield pa.RecordBatch.from_arrays([
                pa.array([*group.column("chunk").to_pylist(), None], pa.string()),
                pa.array([shard] * (len(parts) + 1), pa.int32()),
                pa.array([*(a.tobytes() for a in answers), None], pa.binary()),
                pa.array([*[0] * len(parts), int(total.sum())], pa.int64()),
                pa.array([*[0] * len(parts), int((total > 0).sum())], pa.int64()),
            ], ["chunk", "shard", "answer", "n", "v"])

    dealt = stored.select("chunk", "words", "counts").mapInArrow(
        send, "shard int, chunk string, words binary, counts binary")
    dealt = dealt.repartition(1 << bits, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(count, "chunk string, shard int, answer binary, n long, v long")


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of a hash that are stored: those of the shard, and the lower 48."""
    top = keys >> np.uint64(64 - bits) << np.uint64(64 - bits) if bits else np.uint64(0)
    return (keys & np.uint64((1 << 48) - 1)) | top


def _place(keys: np.ndarray, level: int, probe: int, size: int) -> np.ndarray:
    """The bit of a probe of the keys at a level, in a segment of ``size`` bits."""
    h = _mix(keys + np.uint64(level * int(_A) % 2**64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h & np.uint64(0xFFFFFFFF)) + np.uint64(probe) * step) % np.uint64(size)


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64), MAX_LEVEL)


def segment_bits(counts: np.ndarray) -> int:
    """Bits that hold n-grams with these counts at all their levels."""
    return (int(_levels(counts).sum() * BITS_PER_ENTRY) // 64 + 1) * 64


def segment(keys: np.ndarray, counts: np.ndarray, size: int) -> bytes:
    """A shard's part of the filter: all its n-grams, at every level up to that of their count."""
    levels = _levels(counts)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        present = keys[levels >= level]
        for j in range(PROBES):
            bits[_place(present, level, j, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


class LogFrequencyFilter:
    """Segments in one array of bytes; ``count`` reads quantised counts of n-gram hashes."""

    def __init__(self, data: np.ndarray, bits: int, size: int):
        self.data, self.bits, self.size = data, bits, size

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level found; 0 for what isn't stored."""
        keys = _short(keys, self.bits)
        shard = keys >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(keys), np.uint64)
        base = shard * np.uint64(self.size)
        level = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        for at in range(1, MAX_LEVEL + 1):
            for j in range(PROBES):  # a key is probed on only while all its bits are set
                place = _place(keys[left], at, j, self.size) + base[left]
                bit = self.data[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)
                left = left[(bit & np.uint8(1)).astype(bool)]
            if not len(left):
                break
            level[left] = at
        return level

    def count(self, keys: np.ndarray) -> np.ndarray:
        return quantised(self.levels(keys))


def quantised(levels: np.ndarray) -> np.ndarray:
    """The middle of the range of counts of a level; 0 for level 0."""
    return np.where(levels > 0, 0.75 * 2.0**levels - 0.5, 0.0)


def _pairs(tokens: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (token before, token) of a chunk as before * n_words + token, and the place of each token's pair."""
    return np.unique(_before(tokens).astype(np.int64) * n_words + tokens, return_inverse=True)


def pair_levels(stored: DataFrame, bits: int) -> DataFrame:
    """The filter's answer for each chunk's distinct bigrams: (chunk, shard, answer: a level for each, 0 if unknown).

    A shard builds its segment from the training counts, as large as its own entries need, and answers the chunks.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(_column(batch, c) for c in ("chunk", "words", "sizes", "train", "tokens"))):
                words, sizes, train, tokens = (
                    np.frombuffer(x.as_buffer(), t) for x, t in zip(row[1:], (np.uint64, np.int32, bool, np.int32)))
                pairs, place = _pairs(tokens, len(words))
                counts = np.bincount(place[np.repeat(train, sizes)], minlength=len(pairs)).astype(np.int32)
                keys = _bigram(words[pairs // len(words)], words[pairs % len(words)])
                order, first = _deal(keys, bits)
                rows = [(s, order[first[s]:first[s + 1]]) for s in range(1 << bits) if first[s] < first[s + 1]]
                low = keys.view(np.uint8).reshape(-1, 8)[:, :6]
                yield pa.RecordBatch.from_arrays([
                    pa.array([s for s, _ in rows], pa.int32()), pa.array([row[0].as_py()] * len(rows)),
                    pa.array([low[at].tobytes() for _, at in rows], pa.binary()),
                    pa.array([counts[at].tobytes() for _, at in rows], pa.binary()),
                ], ["shard", "chunk", "keys", "counts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "shard"):
            low = np.concatenate([np.frombuffer(k.as_buffer(), np.uint8).reshape(-1, 6) for k in group.column("keys")])
            keys = np.zeros((len(low), 8), np.uint8)
            keys[:, :6] = low
            keys, place = np.unique(keys.view(np.uint64).ravel(), return_inverse=True)
            parts = [np.frombuffer(c.as_buffer(), np.int32) for c in group.column("counts")]
            total = np.bincount(place, np.concatenate(parts), len(keys)).astype(np.int64)
            seen = total > 0
            size = segment_bits(total[seen])
            data = np.frombuffer(segment(keys[seen], total[seen], size), np.uint8)
            levels = LogFrequencyFilter(data, 0, size).levels(keys).astype(np.uint8)
            answers = np.split(levels[place], np.cumsum([len(p) for p in parts])[:-1])
            yield pa.RecordBatch.from_arrays([
                group.column("chunk").combine_chunks(), group.column("shard").combine_chunks(),
                pa.array([a.tobytes() for a in answers], pa.binary())], ["chunk", "shard", "answer"])

    dealt = stored.select("chunk", "words", "sizes", "train", "tokens").mapInArrow(
        send, "shard int, chunk string, keys binary, counts binary")
    dealt = dealt.repartition(1 << bits, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(answer, "chunk string, shard int, answer binary")


def _before(tokens: np.ndarray) -> np.ndarray:
    """The token before each token. Before a text it is the end of the text before (or of the last): the end token."""
    return np.roll(tokens, 1)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``score`` is the log10 probability of the text, words and end: (c(v w) + PRIOR P(w)) / (c(v) + PRIOR), with c(v w)
    from the filter (at most c(v)), exact c(v) and c(w), and P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). Null and empty texts consist of their end.
    Repeated rows count as often as they are there, in training too; other columns don't matter; of an empty table
    the result is empty.
    """
    # the size of the input decides the number of shards: the work of one stays the same
    volume = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, volume / SHARD_BYTES)))))
    stored = _written(chunks(docs, id_col, text_col), "lm-chunks")
    counted = _written(word_counts(stored, bits), "lm-counts")
    n, v = counted.filter("chunk is null").agg(F.sum("n"), F.sum("v")).first()
    n, v = n or 0, v or 0
    divisor = n + 0.5 * (v + 1)

    answers = counted.filter("chunk is not null").select("chunk", F.lit(False).alias("of_pairs"), "shard", "answer").unionAll(
        pair_levels(stored, bits).select("chunk", F.lit(True).alias("of_pairs"), "shard", "answer"))
    answers = answers.groupBy(F.col("chunk").alias("_chunk")).agg(
        F.collect_list(F.struct("of_pairs", "shard", "answer")).alias("answers"))
    asked = stored.select("chunk", "ids", "words", "sizes", "train", "tokens").join(
        answers, F.col("chunk") == F.col("_chunk"))
    asked = asked.select("ids", "words", "sizes", "train", "tokens", "answers")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids = _column(batch, "ids")[at].values
                words, sizes, train, tokens = (
                    np.frombuffer(_column(batch, c)[at].as_buffer(), t)
                    for c, t in (("words", np.uint64), ("sizes", np.int32), ("train", bool), ("tokens", np.int32)))
                pairs, place = _pairs(tokens, len(words))
                before, word = pairs // len(words), pairs % len(words)
                counts, levels = np.zeros(len(words), np.int64), np.zeros(len(pairs), np.uint8)
                dealt = {False: (*_deal(words, bits), counts), True: (*_deal(_bigram(words[before], words[word]), bits), levels)}
                for answer in _column(batch, "answers")[at].values.to_pylist():
                    order, first, into = dealt[answer["of_pairs"]]
                    s = answer["shard"]
                    into[order[first[s]:first[s + 1]]] = np.frombuffer(answer["answer"], into.dtype)
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                chance = (counts + 0.5) / divisor
                base = np.log10(chance)[tokens]
                often = np.minimum(quantised(levels.astype(np.int64)), counts[before])
                logs = np.log10((often + PRIOR * chance[word]) / (counts[before] + PRIOR))[place]
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(~train), pa.array(sizes.astype(np.int64)),
                    pa.array(np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts)),
                    pa.array(np.full(len(sizes), n, np.int64)),
                    pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(logs, starts)),
                ], [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
        *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")),
        *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score"))])
    return asked.mapInArrow(add, schema)
