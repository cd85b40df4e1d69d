"""Byte-level BPE over a whole table by a global shuffle of distinct words.

Texts are cut into pre-tokens, and each pre-token is put down as the number of its word, in its place. A block is one row
for some megabytes of text: those numbers, and the block's distinct words dealt to shards by hash. A shard encodes
each distinct word once, whatever the number of blocks it stands in, and answers the blocks that asked; a block puts the
ids back in the places of its pre-tokens. A word that is everywhere is one entry per block, so no key is hot; what a task
holds is one block, or the distinct words of one shard. Blocks are written once, in buckets, so a lost executor costs only
reading, and the answers are all that is shuffled to them.
There are never more rows than (block, word) pairs, and as a rule one for each block and shard.

The vocabulary is a file of ranks with a fixed number of entries (at most ``MAX_VOCABULARY``); it is broadcast.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.session import ensure_checkpoint_dir

BLOCK_BYTES = 8 << 20  # of text in a block
BUCKET_BYTES = 64 << 20  # of text for each bucket of blocks
SHARD_BYTES = 32 << 20  # of text for each shard of the words
MAX_VOCABULARY = 1 << 20
SHORT = 48  # bytes up to which a word's pairs are simply looked through again after each merge

# Letters and numbers of Unicode 17, which the regular expressions of the tokenizer's library (Unicode 16)
# don't know yet. There they are neither letters, numbers nor white space, like the unassigned STAND_IN.
NEW = regex.compile("[" + "".join(r"\U%08X-\U%08X" % (int(r.split("-")[0], 16), int(r.split("-")[-1], 16)) for r in """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6
187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD 323B0-33479 3D000-3FC3F
""".split()) + "]")
STAND_IN = "\u0378"


@dataclass(frozen=True)
class Vocabulary:
    """Ranks by bytes, and the pattern of pre-tokens."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """A rank file: a line for each entry, base64 bytes and rank."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        if len(ranks) > MAX_VOCABULARY:
            raise ValueError(f"{len(ranks)} entries are too many to broadcast")
        return cls(ranks, pattern)


def pieces(text: str, pattern: regex.Pattern) -> list[str]:
    """The pre-tokens of a text, in order; together they are the text."""
    cut = np.cumsum([0, *map(len, pattern.findall(NEW.sub(STAND_IN, text)))]).tolist()
    return [text[a:b] for a, b in zip(cut, cut[1:])]


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: itself if it has a rank, else its bytes, merged lowest rank first, leftmost first."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i:i + 1] for i in range(len(word))]
    if len(word) > SHORT:
        return [ranks[p] for p in _merged(parts, ranks)]
    rank = lambda i: ranks.get(parts[i] + parts[i + 1], MAX_VOCABULARY)
    pairs = [rank(i) for i in range(len(parts) - 1)]
    while pairs and (best := min(pairs)) < MAX_VOCABULARY:
        at = pairs.index(best)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = rank(at)
        if at:
            pairs[at - 1] = rank(at - 1)
    return [ranks[p] for p in parts]


def _merged(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """The same merges by a heap of pairs, in n log n steps for words of any length."""
    after = [*range(1, len(parts)), -1]
    before = [-1, *range(len(parts) - 1)]
    alive: list[bytes | None] = list(parts)
    heap = [(ranks[a + b], i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if alive[i] is not None else -1
        if j < 0 or alive[i] + alive[j] != pair:
            continue  # one of the two has been merged since
        alive[i], alive[j] = pair, None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right >= 0 and (new := alive[left] + alive[right]) in ranks:
                heapq.heappush(heap, (ranks[new], left, new))
    return [p for p in alive if p is not None]


class _Numbered(dict):
    """Numbers words in the order in which they are asked for, and notes whether one has a letter that is too new."""

    new = False

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        if not word.isascii() and NEW.search(word):
            self.new = True
        return number


def _pack(numbers: np.ndarray) -> bytes:
    """Small numbers, byte by byte from the lowest, compressed."""
    planes = np.ascontiguousarray(numbers, np.uint32).view(np.uint8).reshape(-1, 4).T
    used = max((k + 1 for k in range(4) if planes[k].any()), default=1)
    return bytes([used]) + zstandard.compress(planes[:used].tobytes(), 3)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, :packed[0]] = planes.T
    return out.view(np.uint32).ravel()


def _block(texts: list[str | None], pattern: regex.Pattern, shards: int) -> tuple[bytes, bytes, bytes, list[bytes]]:
    """(pre-tokens of each text, numbers of their words, sizes of runs, words of each shard).

    Words are numbered by their frequency's power of two, then by shard, then by their bytes: common words have small
    numbers, and the sizes of those runs suffice to find a shard's words again.
    """
    for split in (pattern.findall, lambda text: pieces(text, pattern)):
        numbered, found = _Numbered(), []
        for text in texts:
            cut = split(text or "")
            found.append(np.fromiter(map(numbered.__getitem__, cut), np.uint32, len(cut)))
        if not numbered.new:  # else all is cut again, with care; rare, so texts are not looked through beforehand
            break
    codes = np.concatenate(found)
    words = [w.encode("utf-8", "surrogatepass") for w in numbered]
    level = np.floor(np.log2(np.maximum(np.bincount(codes, minlength=len(words)), 1))).astype(np.int64)
    shard = np.fromiter((xxhash.xxh64_intdigest(w) % shards for w in words), np.int64, len(words))
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    order = order[np.lexsort((shard[order], -level[order]))]
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words))
    top = int(level.max(initial=0))
    runs = np.bincount((top - level) * shards + shard, minlength=(top + 1) * shards)
    dealt = []
    for s in range(shards):
        own = [words[i] for i in order[shard[order] == s]] if shards > 1 else [words[i] for i in order]
        dealt.append(_pack(np.array([len(own), *map(len, own)])) if own else b"")
        if own:
            dealt[-1] = len(dealt[-1]).to_bytes(4, "little") + dealt[-1] + zstandard.compress(b"".join(own), 3)
    return _pack(np.array([len(f) for f in found])), _pack(rank[codes]), _pack(runs), dealt


def _words(payload: bytes) -> list[bytes]:
    cut = 4 + int.from_bytes(payload[:4], "little")
    sizes = _unpack(payload[4:cut])[1:]
    data, ends = zstandard.decompress(payload[cut:]), np.cumsum(sizes).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def blocks(docs: DataFrame, id_col: str, text_col: str, pattern: str, shards: int) -> DataFrame:
    """One row for each block: (block, ids, lengths, stream, runs, words: payload of each shard)."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
        *(T.StructField(c, T.BinaryType()) for c in ("lengths", "stream", "runs")),
        T.StructField("words", T.ArrayType(T.BinaryType()))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        task = TaskContext.get().partitionId() << 32
        made, held = 0, 0
        ids: list[pa.Array] = []
        texts: list[str | None] = []

        def flush() -> pa.RecordBatch:
            lengths, stream, runs, dealt = _block(texts, compiled, shards)
            own = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([task + made]), pa.ListArray.from_arrays([0, len(own)], own),
                *(pa.array([x], pa.binary()) for x in (lengths, stream, runs)),
                pa.array([[x or None for x in dealt]], pa.list_(pa.binary()))], [f.name for f in schema])

        for batch in batches:
            start = 0
            for at, text in enumerate(batch.column(1)):
                texts.append(text.as_py())
                held += len(texts[-1] or "") + 64
                if held >= BLOCK_BYTES:
                    ids.append(batch.column(0)[start:at + 1])
                    yield flush()
                    made, held, start = made + 1, 0, at + 1
                    ids, texts = [], []
            ids.append(batch.column(0)[start:])
        if texts:
            yield flush()

    return docs.select(id_col, text_col).mapInArrow(build, schema)


def _answers(words: DataFrame, vocabulary, shards: int) -> DataFrame:
    """Each shard encodes its distinct words once: (block, shard, sizes, ids) in the order in which a block asked."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = vocabulary.value.ranks
        known: dict[bytes, bytes] = {}
        at = None
        for batch in batches:
            for shard, block, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at:
                    known, at = {}, shard
                own = _words(payload)
                for word in own:
                    if word not in known:
                        known[word] = np.array(encode_word(word, ranks), np.uint32).tobytes()
                found = [known[w] for w in own]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), pa.array([shard], pa.int32()),
                    pa.array([_pack(np.fromiter(map(len, found), np.uint32, len(found)) // 4)], pa.binary()),
                    pa.array([_pack(np.frombuffer(b"".join(found), np.uint32))], pa.binary())],
                    ["block", "shard", "sizes", "ids"])

    dealt = words.select("shard", "block", "payload").repartition(shards, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(encode, "block long, shard int, sizes binary, ids binary")


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """The rows as files in the shared folder, dealt by block: what is joined by block later finds them in their place."""
    spark, name = rows.sparkSession, f"bpe_blocks_{uuid.uuid4().hex}"
    writer = rows.write.bucketBy(buckets, "block").option("compression", "uncompressed")
    writer.option("path", f"{ensure_checkpoint_dir(spark)}/{name}").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # from the catalogue; the files stay
    return stored


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _reassembler(shards: int, id_col: str):
    """From rows (ids, lengths, stream, runs, answers) to (id, ids of the text)."""
    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, *packed, answers in zip(*batch.columns):
                lengths, stream, runs = (_unpack(x.as_py()) for x in packed)
                runs = runs.astype(np.int64).reshape(-1, shards)
                first = (np.cumsum(runs) - runs.ravel()).reshape(runs.shape)
                size, start = np.zeros(runs.sum(), np.int64), np.zeros(runs.sum(), np.int64)
                flat, before = [], 0
                for answer in answers.as_py() or []:  # none if all texts are empty
                    own = _spread(first[:, answer["shard"]], runs[:, answer["shard"]])
                    size[own] = _unpack(answer["sizes"])
                    flat.append(_unpack(answer["ids"]))
                    start[own] = before + np.cumsum(size[own]) - size[own]
                    before += len(flat[-1])
                tokens = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
                ends = np.cumsum(lengths).tolist()
                out, held, done = [], 0, 0
                for i, (a, b) in enumerate(zip([0, *ends], ends)):
                    out.append(tokens[_spread(start[stream[a:b]], size[stream[a:b]])].tobytes())
                    held += len(out[-1])
                    if held >= 8 << 20 or i == len(ends) - 1:
                        yield pa.RecordBatch.from_arrays(
                            [doc_ids.values[done:i + 1], pa.array(out, pa.binary())], [id_col, "ids"])
                        out, held, done = [], 0, i + 1

    return reassemble


def _asked(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The blocks with the shards' answers, and the number of shards."""
    spark = docs.sparkSession
    volume = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = 1 + volume // SHARD_BYTES
    buckets = max(1 + volume // BUCKET_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stored = _bucketed(blocks(docs, id_col, text_col, vocabulary.pattern, shards), buckets)
    words = stored.select("block", F.posexplode("words").alias("shard", "payload")).filter("payload is not null")
    answers = _answers(words, spark.sparkContext.broadcast(vocabulary), shards).repartition(buckets, "block")
    answers = answers.groupBy(F.col("block").alias("_block")).agg(F.collect_list(F.struct("shard", "sizes", "ids")).alias("answers"))
    asked = stored.join(answers, F.col("block") == F.col("_block"), "left").select("ids", "lengths", "stream", "runs", "answers")
    return asked, shards


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids: binary, little-endian unsigned 32-bit numbers) for every row of ``docs``.

    A null text has no ids, like an empty one. Repeated rows, null and repeated ids are rows of their own; other columns
    don't matter; of an empty table the result is empty. The vocabulary must have all 256 single bytes.
    """
    asked, shards = _asked(docs, vocabulary, id_col, text_col)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.BinaryType())])
    return asked.mapInArrow(_reassembler(shards, id_col), schema)


def _decoder(spark, vocabulary: Vocabulary, at: int, bytes_col: str):
    """Adds the bytes of the ids in column ``at``, by a join with the table of tokens (broadcast, in numpy)."""
    by_id = {rank: word for word, rank in vocabulary.ranks.items()}
    words = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
    table = spark.sparkContext.broadcast((b"".join(words), np.array([len(w) for w in words], np.int64)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, size = np.frombuffer(table.value[0], np.uint8), table.value[1]
        start = np.cumsum(size) - size
        for batch in batches:
            out = []
            for value in batch.column(at):
                if not value.is_valid:
                    out.append(None)
                    continue
                ids = np.frombuffer(value.as_buffer(), np.uint32)
                if not size[ids].all():
                    raise ValueError("an id has no bytes in this vocabulary")
                out.append(data[_spread(start[ids], size[ids])].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, bytes_col])

    return look_up


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """The columns of ``encoded`` and the bytes of its ids.

    Null ids decode to null. An id that isn't in the vocabulary is an error. Of an empty table the result is empty.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField(bytes_col, T.BinaryType())])
    return encoded.mapInArrow(_decoder(encoded.sparkSession, vocabulary, encoded.columns.index(ids_col), bytes_col), schema)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): ``encode`` and then ``decode``, in the same tasks."""
    asked, shards = _asked(docs, vocabulary, id_col, text_col)
    there, back = _reassembler(shards, id_col), _decoder(docs.sparkSession, vocabulary, 1, "decoded")
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    return asked.mapInArrow(lambda batches: back(there(batches)), schema)
