"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is its own vector next to the mean of the vectors of its character trigrams; a network of gated
recurrent units reads a window of words from both ends, and attention pools their states. Every text is covered by
overlapping windows, all of them are scored, and its score is that of its worst window. Training labels are for whole
texts: in each round the worst window of each text stands for it, and after some rounds toxic labels without any window
that looks so are no longer learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.llm.text import LOWER, fresh, remainder

WINDOW = 32  # words
STRIDE = 24
UNITS = 8  # states of each direction
WIDTH = 8  # numbers of a word's own vector, and of its characters' vector
WORDS = 1 << 15  # hashed words and trigrams
TRIGRAMS = 1 << 13
SAMPLE_TOXIC, SAMPLE_CLEAN = 800, 1600  # texts to learn from, at most
MIN_TEXTS = 8  # rarer words keep a zero vector: only their characters speak
ROUNDS, STEPS = 8, 60  # at least so many rounds and steps
TRUST_FROM = 0.6  # after this part of the rounds, toxic labels that the network finds no reason for are left out
TRUST = -0.7  # log odds
BATCH = 256
CACHE_WORDS = 200_000
EDGE = b".,;:!?*%&$#\"'()|<>"


@dataclass
class Lexicon:
    """Features of distinct words: number of the word, and its trigrams one after the other."""

    word: np.ndarray
    grams: np.ndarray
    owner: np.ndarray
    count: np.ndarray


def lexicon(words: list[bytes]) -> Lexicon:
    cores = [w.strip(EDGE) or w for w in words]
    marked = b"".join(b"\x02" + c + b"\x03" for c in cores)
    text = np.frombuffer(marked, np.uint8).astype(np.int64)
    sizes = np.fromiter((len(c) for c in cores), np.int64, len(cores))
    grams = (text[:-2] * 7919 + text[1:-1] * 313 + text[2:]) % TRIGRAMS if len(text) > 2 else np.zeros(0, np.int64)
    first = np.cumsum(sizes + 2) - sizes - 2
    at = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else first, sizes) + np.arange(sizes.sum())
    return Lexicon(
        np.fromiter((xxhash.xxh32_intdigest(c) % WORDS for c in cores), np.int64, len(cores)),
        grams[at], np.repeat(np.arange(len(cores)), sizes), sizes)


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first token, end) of every window of texts of these sizes, laid one after the other. A text shorter
    than a window has one; the last window of a longer one ends with the text."""
    number = np.where(sizes <= WINDOW, 1, -(-(sizes - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(sizes)), number)
    place = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    begin = np.cumsum(sizes) - sizes
    first = begin[text] + np.minimum(place * STRIDE, np.maximum(sizes - WINDOW, 0)[text])
    return text, first, np.minimum(first + WINDOW, (begin + sizes)[text])


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    out = {"words": normal(WORDS, WIDTH, scale=0.1), "grams": normal(TRIGRAMS, WIDTH, scale=0.1),
           "attend": normal(2 * UNITS, scale=0.3), "out": normal(2 * UNITS, scale=0.3), "bias": np.zeros(1, np.float32)}
    for way in "fb":
        out |= {f"x{way}": normal(2 * WIDTH, 3 * UNITS, scale=0.3), f"h{way}": normal(UNITS, 3 * UNITS, scale=0.3),
                f"c{way}": np.zeros(3 * UNITS, np.float32)}
    return out


def word_inputs(p: dict[str, np.ndarray], lex: Lexicon) -> np.ndarray:
    chars = np.zeros((len(lex.word), WIDTH), np.float32)
    if len(lex.grams):
        full = np.flatnonzero(lex.count)
        starts = (np.cumsum(lex.count) - lex.count)[full]
        chars[full] = np.add.reduceat(p["grams"][lex.grams], starts, axis=0)
        chars /= np.maximum(lex.count, 1)[:, None]
    return np.concatenate([p["words"][lex.word], chars], 1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _read(gates: np.ndarray, codes: np.ndarray, mask: np.ndarray, recur: np.ndarray, backward: bool, trace: list | None):
    """States (steps, windows, UNITS) of one direction; ``gates`` are the words' inputs to the gates."""
    steps = codes.shape[1]
    states = np.zeros((steps, len(codes), UNITS), np.float32)
    h = np.zeros((len(codes), UNITS), np.float32)
    for t in reversed(range(steps)) if backward else range(steps):
        x = gates[codes[:, t]]
        y = h @ recur
        zr = _sigmoid(x[:, :2 * UNITS] + y[:, :2 * UNITS])
        z, r = zr[:, :UNITS], zr[:, UNITS:]
        new = np.tanh(x[:, 2 * UNITS:] + r * y[:, 2 * UNITS:])
        after = new + z * (h - new)
        m = mask[:, t, None]
        after = np.where(m, after, h)
        if trace is not None:
            trace.append((t, h, z, r, new, y[:, 2 * UNITS:]))
        h = after
        states[t] = h
    return states


def forward(p: dict[str, np.ndarray], inputs: np.ndarray, codes: np.ndarray, mask: np.ndarray, trace: dict | None = None):
    """Log odds of each window. ``codes`` (windows, WINDOW) number rows of ``inputs``."""
    ways = []
    for way in "fb":
        steps: list | None = None if trace is None else []
        ways.append(_read(inputs @ p[f"x{way}"] + p[f"c{way}"], codes, mask, p[f"h{way}"], way == "b", steps))
        if trace is not None:
            trace[way] = steps
    states = np.concatenate(ways, 2)
    heat = np.where(mask.T, states @ p["attend"], -30.0)
    share = np.exp(heat - heat.max(0))
    share = share * mask.T
    share /= np.maximum(share.sum(0), 1e-9)
    pooled = np.einsum("tb,tbh->bh", share, states)
    if trace is not None:
        trace |= {"states": states, "share": share, "pooled": pooled}
    return pooled @ p["out"] + p["bias"][0]


def gates_of(p: dict[str, np.ndarray], inputs: np.ndarray) -> list[np.ndarray]:
    """What the words of ``inputs`` add to the three gates, forwards and then backwards."""
    out = []
    for way in "fb":
        full = inputs @ p[f"x{way}"] + p[f"c{way}"]
        out += [np.ascontiguousarray(full[:, i * UNITS:(i + 1) * UNITS]) for i in range(3)]
    return out


def odds_of_full(p: dict[str, np.ndarray], gates: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """``forward`` for windows without a gap, on stored gates; ``codes`` is (WINDOW, windows)."""
    steps, size = codes.shape
    states = np.empty((steps, size, 2 * UNITS), np.float32)
    for k, way in enumerate("fb"):
        to_z, to_r, to_n = gates[3 * k:3 * k + 3]
        recur = [np.ascontiguousarray(p[f"h{way}"][:, i * UNITS:(i + 1) * UNITS]) for i in range(3)]
        h = np.zeros((size, UNITS), np.float32)
        for t in reversed(range(steps)) if k else range(steps):
            c = codes[t]
            z, r, y = h @ recur[0], h @ recur[1], h @ recur[2]
            z += to_z[c]
            z *= 0.5
            np.tanh(z, out=z)
            r += to_r[c]
            r *= 0.5
            np.tanh(r, out=r)
            r += 1
            r *= 0.5
            y *= r
            y += to_n[c]
            np.tanh(y, out=y)  # h = new + z (h - new), z = (1 + tanh) / 2
            h -= y
            z += 1
            z *= 0.5
            h *= z
            h += y
            states[t, :, k * UNITS:(k + 1) * UNITS] = h
    heat = states @ p["attend"]
    worth = states @ p["out"]
    heat -= heat.max(0)
    np.exp(heat, out=heat)
    return (heat * worth).sum(0) / heat.sum(0) + p["bias"][0]


def backward(p, inputs, lex: Lexicon, codes, mask, trace, error) -> dict[str, np.ndarray]:
    """Gradients of the sum of error x log odds."""
    states, share, pooled = trace["states"], trace["share"], trace["pooled"]
    g = {"out": pooled.T @ error, "bias": np.array([error.sum()], np.float32)}
    d_pooled = error[:, None] * p["out"]
    along = np.einsum("tbh,bh->tb", states, d_pooled)
    d_heat = share * (along - (share * along).sum(0))
    g["attend"] = np.einsum("tb,tbh->h", d_heat, states)
    d_states = share[:, :, None] * d_pooled + d_heat[:, :, None] * p["attend"]
    d_inputs = np.zeros_like(inputs)
    for k, way in enumerate("fb"):
        recur = p[f"h{way}"]
        d_gates = np.zeros((len(inputs), 3 * UNITS), np.float32)
        d_recur = np.zeros_like(recur)
        d_next = np.zeros((len(codes), UNITS), np.float32)
        for t, before, z, r, new, y in reversed(trace[way]):
            total = d_states[t][:, k * UNITS:(k + 1) * UNITS] + d_next
            m = mask[:, t, None]
            dh = np.where(m, total, 0)
            d_new = dh * (1 - z) * (1 - new**2)
            d_z = dh * (before - new) * z * (1 - z)
            d_r = d_new * y * r * (1 - r)
            to_x = np.concatenate([d_z, d_r, d_new], 1)
            to_y = np.concatenate([d_z, d_r, d_new * r], 1)
            np.add.at(d_gates, codes[:, t], to_x)
            d_recur += before.T @ to_y
            d_next = np.where(m, dh * z + to_y @ recur.T, total)
        g |= {f"h{way}": d_recur, f"c{way}": d_gates.sum(0), f"x{way}": inputs.T @ d_gates}
        d_inputs += d_gates @ p[f"x{way}"].T
    g["words"], g["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
    np.add.at(g["words"], lex.word, d_inputs[:, :WIDTH])
    np.add.at(g["grams"], lex.grams, (d_inputs[:, WIDTH:] / np.maximum(lex.count, 1)[:, None])[lex.owner])
    return g


def _matrix(first: np.ndarray, end: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = first[:, None] + np.arange(WINDOW)
    mask = at < end[:, None]
    return (codes[np.minimum(at, len(codes) - 1)] if len(codes) else np.zeros(at.shape, np.int64)), mask


def train(texts: list[str | None], toxic: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """The network's parameters. Without texts of both kinds it knows nothing and gives every text the same score."""
    rng = np.random.default_rng(seed)
    p = initial(rng)
    if len(set(toxic.tolist())) < 2:
        p["out"][:] = 0
        return p
    found = [tokens_of(t) for t in texts]
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for t in found for w in t], np.int64)
    sizes = np.array([len(t) for t in found])
    lex = lexicon(list(number))
    # a word's first number starts from how much more often toxic texts have it
    owner = np.repeat(np.arange(len(texts)), sizes)
    pairs = np.unique(lex.word[codes] * len(texts) + owner)
    has, whose = pairs // len(texts), pairs % len(texts)
    bad = np.bincount(has, toxic[whose], WORDS)
    every = np.bincount(has, minlength=WORDS)
    lean = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((every - bad + 0.5) / (len(toxic) - toxic.sum() + 1))
    common = every >= MIN_TEXTS
    p["words"][:, 0] = np.clip(lean / 4, -2, 2)
    p["words"][~common] = 0
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    text, first, end = windows(sizes)
    step = 0
    rounds = max(ROUNDS, -(-STEPS // max(1, len(texts) * 3 // 2 // BATCH)))
    for turn in range(rounds):
        inputs = word_inputs(p, lex)
        odds = np.concatenate([forward(p, inputs, *_matrix(first[a:a + 4096], end[a:a + 4096], codes))
                               for a in range(0, len(first), 4096)])
        worst = np.lexsort((odds, text))[np.cumsum(np.bincount(text)) - 1]
        if turn >= TRUST_FROM * rounds:  # some toxic labels are wrong; learning them by heart would cost clean texts
            worst = worst[(toxic[text[worst]] == 0) | (odds[worst] > TRUST)]
        clean = np.flatnonzero(toxic[text] == 0)
        used = np.concatenate([worst, rng.choice(clean, min(len(clean), len(worst) // 2), replace=False)])
        for part in np.array_split(rng.permutation(used), max(1, len(used) // BATCH)):
            step += 1
            matrix, mask = _matrix(first[part], end[part], codes)
            distinct, small = np.unique(matrix, return_inverse=True)
            own = lexicon_part(lex, distinct)
            inputs = word_inputs(p, own)
            trace: dict = {}
            chance = _sigmoid(forward(p, inputs, small.reshape(matrix.shape), mask, trace))
            error = ((chance - toxic[text[part]]) / len(part)).astype(np.float32)
            for k, gradient in backward(p, inputs, own, small.reshape(matrix.shape), mask, trace, error).items():
                if k == "words":
                    gradient[~common] = 0
                a, b = moments[k]
                a += 0.1 * (gradient - a)
                b += 0.01 * (gradient**2 - b)
                p[k] -= 0.01 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-7)
    return p


def lexicon_part(lex: Lexicon, chosen: np.ndarray) -> Lexicon:
    starts = np.cumsum(lex.count) - lex.count
    count = lex.count[chosen]
    owner = np.repeat(np.arange(len(chosen)), count)
    at = starts[chosen][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return Lexicon(lex.word[chosen], lex.grams[at], owner, count)


class Scorer:
    """Scores of texts with given parameters; keeps the gates' inputs of words it has met, up to a bound."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        self.number: dict[bytes, int] = {}
        self.gates = gates_of(p, np.zeros((2 * CACHE_WORDS, 2 * WIDTH), np.float32))

    def learn(self, found: list[list[bytes]]) -> np.ndarray:
        """Numbers of the words, in text order."""
        for _ in range(2):
            number = self.number
            known = len(number)
            codes = np.array([number.setdefault(w, len(number)) for t in found for w in t], np.int64)
            if len(number) <= CACHE_WORDS or not known:
                break
            self.number = {}  # full: start again with these texts
        if len(number) > len(self.gates[0]):  # texts with more words than the bound
            self.gates = [np.concatenate([g, np.zeros((len(number) - len(g), UNITS), np.float32)]) for g in self.gates]
        if len(number) > known:
            new = list(number)[known:]
            for gate, values in zip(self.gates, gates_of(self.p, word_inputs(self.p, lexicon(new)))):
                gate[known:len(number)] = values
        return codes

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, number of windows, first word of the worst window) of each text."""
        found = [tokens_of(t) for t in texts]
        codes = self.learn(found)
        sizes = np.array([len(t) for t in found], np.int64)
        text, first, end = windows(sizes)
        odds = np.empty(len(text), np.float32)
        full = np.flatnonzero(end - first == WINDOW)
        for a in range(0, len(full), 2048):
            at = full[a:a + 2048]
            odds[at] = odds_of_full(self.p, self.gates, codes[first[at] + np.arange(WINDOW)[:, None]])
        short = np.flatnonzero(end - first < WINDOW)
        if len(short):
            matrix, mask = _matrix(first[short], end[short], codes)
            distinct, small = np.unique(matrix, return_inverse=True)
            names = list(self.number)
            inputs = word_inputs(self.p, lexicon([names[i] for i in distinct] if names else [b""]))
            odds[short] = forward(self.p, inputs, small.reshape(matrix.shape), mask)
        count = np.bincount(text, minlength=len(texts))
        worst = np.lexsort((-first, odds, text))[np.cumsum(count) - 1]
        begin = np.cumsum(sizes) - sizes
        return _sigmoid(odds[worst].astype(np.float64)), count, first[worst] - begin


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[list[str | None], np.ndarray]:
    """Labelled training texts: of each kind the ones with the smallest hashes of their ids, up to the bound."""
    marks = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max("toxic").alias("_toxic"), F.min("toxic").alias("_least")).filter("_toxic = _least")
    marks = marks.filter(remainder(F.col("_id")) != 0)
    by_hash = [F.xxhash64("_id"), F.col("_id")]
    chosen = marks.filter("_toxic = 1").orderBy(*by_hash).limit(SAMPLE_TOXIC).unionByName(
        marks.filter("_toxic = 0").orderBy(*by_hash).limit(SAMPLE_CLEAN))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), "_id").dropDuplicates(["_id"]).select("_id", "_text", "_toxic").toArrow().sort_by("_id")
    return rows.column("_text").to_pylist(), rows.column("_toxic").to_numpy().astype(np.float32)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``toxicity`` (0 to 1), ``windows`` and ``worst_word``, where its worst window begins.

    Null and empty texts have one empty window. Rows are scored each on their own: repeated rows, null ids and other
    columns don't matter. Ids labelled both ways, null labels and held-out ids (fold 0) teach nothing.
    """
    p = train(*sample(docs, labels, id_col, text_col))
    kept = [f for f in docs.schema.fields if f.name != text_col]
    new = [fresh(docs, c) for c in ("toxicity", "windows", "worst_word")]
    schema = T.StructType([*kept, T.StructField(new[0], T.DoubleType()), T.StructField(new[1], T.LongType()),
                           T.StructField(new[2], T.LongType())])
    names = [f.name for f in kept]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(p)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = scorer(part.column(part.schema.get_field_index(text_col)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(n)) for n in names), pa.array(found[0]),
                     pa.array(found[1].astype(np.int64)), pa.array(found[2].astype(np.int64))], [*names, *new])

    return docs.mapInArrow(add, schema)
