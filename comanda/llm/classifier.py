"""A small text classifier: softmax regression on hashed words, their endings and shapes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BUCKETS = 1 << 18  # hashed words; endings, shapes and document features follow
ENDINGS, SHAPES, SIZES, RATIOS = 256, 8, 24, 12
FEATURES = BUCKETS + ENDINGS + SHAPES + SIZES + RATIOS


@dataclass
class Bag:
    """The words of a batch of texts: tokens in text order as codes of distinct words, and features by word."""

    starts: np.ndarray  # first token of each text, and the end
    codes: np.ndarray
    by_word: np.ndarray  # (distinct words, 3) feature numbers
    by_text: np.ndarray  # (texts, 2) feature numbers

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)


def _word_features(word: str) -> tuple[int, int, int]:
    core = word.strip(".,;:!?*%&$#\"'()|<>").lower()
    shape = (word.isupper() << 2) | (word.islower() << 1) | (not word.isalpha())
    return (xxhash.xxh32_intdigest(core.encode("utf-8", "surrogatepass")) % BUCKETS, BUCKETS + ord(word[-1]) % ENDINGS,
            BUCKETS + ENDINGS + int(shape))


def bag(texts: pa.Array) -> Bag:
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    starts = np.concatenate([[0], np.cumsum(full)])[offsets]
    encoded = flat.filter(pa.array(full)).dictionary_encode()
    by_word = np.array([_word_features(w) for w in encoded.dictionary.to_pylist()], np.int64).reshape(-1, 3)
    codes = encoded.indices.to_numpy().astype(np.int64)
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    new = np.ones(len(codes), bool)
    order = np.lexsort((codes, owner))
    new[1:] = (codes[order][1:] != codes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=len(sizes))
    base = BUCKETS + ENDINGS + SHAPES
    size_of = base + np.minimum(np.log2(sizes + 1).astype(np.int64), SIZES - 1)
    ratio_of = base + SIZES + (10 * distinct / np.maximum(sizes, 1)).astype(np.int64)
    return Bag(starts, codes, by_word, np.stack([size_of, ratio_of], 1))


def logits(b: Bag, weights: np.ndarray) -> np.ndarray:
    by_word = weights[b.by_word].sum(1)
    owner = np.repeat(np.arange(len(b.sizes)), b.sizes)
    sums = np.stack([np.bincount(owner, by_word[b.codes, k], len(b.sizes)) for k in range(weights.shape[1])], 1)
    return sums / np.sqrt(np.maximum(b.sizes, 1))[:, None] + weights[b.by_text].sum(1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _telling(b: Bag, owner: np.ndarray, labels: np.ndarray, classes: int, min_texts: int) -> np.ndarray:
    """For each feature the largest log ratio of its share of one class's texts to its share of the others'."""
    def texts_with(features: np.ndarray, texts: np.ndarray) -> np.ndarray:
        pairs = np.unique(features * len(labels) + texts)
        return np.stack([np.bincount(pairs // len(labels), labels[pairs % len(labels)] == k, FEATURES)
                         for k in range(classes)], 1)

    texts = np.arange(len(labels))
    found = sum(texts_with(b.by_word[b.codes, j], owner) for j in range(b.by_word.shape[1]))
    found = found + sum(texts_with(b.by_text[:, j], texts) for j in range(b.by_text.shape[1]))
    sizes = np.bincount(labels, minlength=classes)
    inside = (found + 1) / (sizes + 2)
    outside = (found.sum(1, keepdims=True) - found + 1) / (sizes.sum() - sizes + 2)
    ratio = np.abs(np.log(inside / outside)).max(1)
    ratio[:BUCKETS][found[:BUCKETS].sum(1) < min_texts] = 0.0
    return ratio[:, None]


def train(b: Bag, labels: np.ndarray, classes: int, rounds: int = 40, rate: float = 0.1, decay: float = 1e-4,
          min_texts: int = 5) -> np.ndarray:
    """Weights (features, classes) by Adam on the whole sample; all zero, so equal posteriors, for an empty one.

    Hashed words that fewer than ``min_texts`` texts of the sample have keep the weight 0.
    """
    weights = np.zeros((FEATURES, classes), np.float32)
    if not len(labels):
        return weights
    weights = weights.astype(np.float64)
    owner = np.repeat(np.arange(len(b.sizes)), b.sizes)
    scale = _telling(b, owner, labels, classes, min_texts)
    target = np.eye(classes)[labels]
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        error = (softmax(logits(b, scale * weights)) - target) / len(labels)
        share = error / np.sqrt(np.maximum(b.sizes, 1))[:, None]
        by_word = np.stack([np.bincount(b.codes, share[owner, k], len(b.by_word)) for k in range(classes)], 1)
        gradient = np.zeros_like(weights)
        for j in range(b.by_word.shape[1]):
            for k in range(classes):
                gradient[:, k] += np.bincount(b.by_word[:, j], by_word[:, k], FEATURES)
        for j in range(b.by_text.shape[1]):
            for k in range(classes):
                gradient[:, k] += np.bincount(b.by_text[:, j], error[:, k], FEATURES)
        gradient = gradient * scale + decay * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return (scale * weights).astype(np.float32)
