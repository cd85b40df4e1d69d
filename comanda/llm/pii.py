"""Personal data in texts: fixed patterns, and a skip-chain conditional random field that carries them on.

The field's nodes are the words of a document with a digit or an at sign; all other words are no personal data. Words
that stand next to each other share a chain potential. Words that repeat anywhere in the document, or that have the same
letters and digits, share a skip potential with the occurrence before, so agreement spreads over all of them with one
edge each. Loopy belief propagation gives the labels. What the patterns find is known evidence there; the field adds
what resembles it (a number written without its country code, an address cut off) where the document supports it.

The potentials are trained piecewise (Sutton and McCallum, 2005) on a bounded sample, with the patterns as labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.llm.text import fresh

KINDS = ["email", "ip", "card", "phone"]
OTHER = len(KINDS)  # label of a word that is none of them

# Base patterns, fixed values; possessive where giving back can't help, so that long runs stay linear.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ACTIVE = re.compile(r"[0-9@]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
EDGE = ".,;:!?()[]{}<>\"'*%&$#|"

BUCKETS = 1 << 13
FEATURES = 10
SAMPLE_ROWS = 3000
ROUNDS = 12  # of messages
DAMPING = 0.5
SURE = 0.97
KNOWN = 12.0  # log odds of a word inside a base span


def emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start: leftmost matches that don't overlap, less those that fail their check."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if not ACTIVE.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub("[^0-9]", "", m[0])
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def words_of(text: str) -> list[tuple[int, int]]:
    """Places of the words with a digit or an at sign."""
    out, hit = [], ACTIVE.search(text)
    while hit:
        start = hit.start()
        while start and text[start - 1] not in SPACE:
            start -= 1
        end = WORD.match(text, hit.start()).end()
        out.append((start, end))
        hit = ACTIVE.search(text, end)
    return out


def _shape(word: str) -> str:
    runs = re.sub(r"[^\W\d_]+", "a", word)
    return re.sub(r"[0-9]+", lambda m: f"9{min(len(m[0]), 20)}", runs)[:60]


def _features(text: str, start: int, end: int) -> list[int]:
    word = text[start:end]
    core = word.strip(EDGE)
    digits = sum(c.isdigit() for c in core)
    before = text[max(0, start - 24):start].rstrip(SPACE)
    before = re.split(r"[\x20\x09-\x0D]", before)[-1]
    after = WORD.match(text, end + 1) if end + 1 < len(text) else None
    names = [
        f"shape {_shape(core)}", f"form {re.sub('[0-9]+', '9', _shape(core))}", f"digits {min(digits, 24)}",
        f"at {core.count('@')}", f"dots {min(core.count('.'), 5)}", f"first {_shape(word[:1])}", f"last {_shape(word[-1:])}",
        f"before {re.sub('[0-9]+', '9', _shape(before))}", f"after {re.sub('[0-9]+', '9', _shape(after[0][:24])) if after else ''}",
        "always",
    ]
    return [xxhash.xxh32_intdigest(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in names]


@dataclass
class Graph:
    """The words of some documents: features, evidence, and edges (chain, skip) between them."""

    where: list[tuple[int, int, int]]  # document, start, end
    features: np.ndarray
    known: np.ndarray  # label by a base span, or -1
    chain: np.ndarray  # (edges, 2)
    skip: np.ndarray


def graph(texts: list[str], bases: list[list[tuple[int, int, int]]]) -> Graph:
    where, features, known, chain, skip = [], [], [], [], []
    for doc, (text, base) in enumerate(zip(texts, bases)):
        last: dict[str, int] = {}
        by_start = sorted((s, e, k) for k, s, e in base)
        at, previous = 0, None
        for start, end in words_of(text):
            node = len(where)
            while at < len(by_start) and by_start[at][1] <= start:
                at += 1
            label = -1
            for s, e, k in by_start[at:]:
                if s >= end:
                    break
                if e > start:
                    label = k
                    break
            where.append((doc, start, end))
            features.append(_features(text, start, end))
            known.append(label)
            if previous is not None and start - previous[1] == 1:
                chain.append((previous[0], node))
            previous = (node, end)
            core = text[start:end].strip(EDGE).lower()
            for key in {core, "~" + re.sub(r"[\W_]+", "", core)}:
                if len(key) > 4:
                    if key in last:
                        skip.append((last[key], node))
                    last[key] = node
    pairs = lambda x: np.array(sorted(set(x)), np.int64).reshape(-1, 2)
    return Graph(where, np.array(features, np.int64).reshape(-1, FEATURES), np.array(known, np.int64), pairs(chain), pairs(skip))


@dataclass
class Potentials:
    words: np.ndarray  # (BUCKETS, labels)
    chain: np.ndarray  # (labels, labels), log
    skip: np.ndarray


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[str], rounds: int = 150) -> Potentials:
    """Each kind of factor on its own, with the base patterns as labels."""
    labels = OTHER + 1
    g = graph(texts, [base_spans(t) for t in texts])
    words = np.zeros((BUCKETS, labels))
    if not len(g.known) or (g.known < 0).all():
        words[:, OTHER] = 1.0  # nothing to learn from: nothing is added
        return Potentials(words, np.zeros((labels, labels)), np.zeros((labels, labels)))
    y = np.where(g.known < 0, OTHER, g.known)
    target = np.eye(labels)[y]
    first, second = np.zeros_like(words), np.zeros_like(words)
    for step in range(1, rounds + 1):
        error = (_softmax(words[g.features].sum(1)) - target) / len(y)
        gradient = 1e-5 * words
        np.add.at(gradient, g.features, error[:, None, :])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        words -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    share = (np.bincount(y, minlength=labels) + 1) / (len(y) + labels)

    def pairwise(edges: np.ndarray) -> np.ndarray:
        """How much more often two labels meet than by chance."""
        counts = np.full((labels, labels), 0.5)
        np.add.at(counts, (y[edges[:, 0]], y[edges[:, 1]]), 1)
        return np.clip(np.log(counts / counts.sum() / share[:, None] / share[None, :]), -3, 3)

    skip = pairwise(g.skip)
    return Potentials(words.astype(np.float32), pairwise(g.chain), (skip + skip.T) / 2)


def beliefs(g: Graph, p: Potentials) -> np.ndarray:
    """Label probabilities of every word, by damped loopy belief propagation over all documents at once."""
    node = p.words[g.features].sum(1).astype(np.float64)
    seen = np.flatnonzero(g.known >= 0)
    node[seen, g.known[seen]] += KNOWN
    node -= np.log(np.exp(node - node.max(1, keepdims=True)).sum(1, keepdims=True)) + node.max(1, keepdims=True)
    source = np.concatenate([g.chain[:, 0], g.chain[:, 1], g.skip[:, 0], g.skip[:, 1]])
    goal = np.concatenate([g.chain[:, 1], g.chain[:, 0], g.skip[:, 1], g.skip[:, 0]])
    if not len(source):
        return np.exp(node)
    a, b = len(g.chain), len(g.skip)
    back = np.concatenate([np.arange(a, 2 * a), np.arange(a), np.arange(2 * a + b, 2 * a + 2 * b), np.arange(2 * a, 2 * a + b)])
    factor = np.concatenate([np.repeat(m[None], n, 0) for m, n in ((p.chain, a), (p.chain.T, a), (p.skip, b), (p.skip.T, b))])
    message = np.zeros((len(source), node.shape[1]))
    for _ in range(ROUNDS):
        total = node.copy()
        np.add.at(total, goal, message)
        incoming = (total[source] - message[back])[:, :, None] + factor
        top = incoming.max(1, keepdims=True)
        new = np.log(np.exp(incoming - top).sum(1)) + top[:, 0]
        new -= new.max(1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * new
    total = node.copy()
    np.add.at(total, goal, message)
    return _softmax(total)


def added_spans(texts: list[str], bases: list[list[tuple[int, int, int]]], p: Potentials) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) of what the field is sure of beyond the base spans; neighbours of one kind are one span."""
    g = graph(texts, bases)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(g.where):
        return out
    chance = beliefs(g, p)
    label = chance.argmax(1)
    sure = np.flatnonzero((label != OTHER) & (g.known < 0) & (chance.max(1) >= SURE))
    for i in sure.tolist():
        doc, start, end = g.where[i]
        word = texts[doc][start:end]
        start, end = start + len(word) - len(word.lstrip(EDGE)), end - len(word) + len(word.rstrip(EDGE))
        kind = int(label[i])
        if start >= end:
            continue
        if out[doc] and out[doc][-1][0] == kind and start - out[doc][-1][2] <= 2:
            out[doc][-1] = (kind, out[doc][-1][1], end)
        else:
            out[doc].append((kind, start, end))
    return out


def sample(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Texts with a digit or an at sign, those with the smallest hashes."""
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    keyed = docs.select(F.col(text_col).alias("_text"), key.alias("_key"))
    chosen = keyed.filter(F.col("_text").rlike("[0-9@]")).select("_key").distinct().orderBy("_key").limit(SAMPLE_ROWS)
    rows = keyed.join(F.broadcast(chosen), "_key").dropDuplicates(["_key"])
    return rows.toArrow().sort_by("_key").column("_text").to_pylist()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``spans``: array of (kind, start, end, base) in code points, by kind and start.

    ``kind`` is an index into ``KINDS``; ``base`` tells the patterns' spans from the field's. Null and empty texts have
    none. Rows are scanned each on their own: repeated rows, null ids and other columns don't matter.
    """
    p = train(sample(docs, id_col, text_col))
    kept = [f for f in docs.schema.fields if f.name != text_col]
    spans_col = fresh(docs, "spans")
    span = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())])
    schema = T.StructType([*kept, T.StructField(spans_col, T.ArrayType(span))])
    names = [f.name for f in kept]
    arrow_span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t or "" for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
                bases = [base_spans(t) for t in texts]
                added = added_spans(texts, bases, p)
                rows = [sorted([(k, s, e, True) for k, s, e in b] + [(k, s, e, False) for k, s, e in a])
                        for b, a in zip(bases, added)]
                found = pa.array([[dict(zip(("kind", "start", "end", "base"), x)) for x in r] for r in rows], arrow_span)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(n)) for n in names), found], [*names, spans_col])

    return docs.mapInArrow(add, schema)
