"""Soft-membership mixing: document rates whose expected domain totals match target weights."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.llm import classifier
from comanda.llm.text import fresh
from comanda.session import cut_lineage

#: Domains of the label table, and the share of all tokens that each is to have.
DOMAINS = ("clean", "poor", "toxic")
PART_ROWS = 200  # texts that a worker takes apart at once
TARGETS = (0.90, 0.08, 0.02)

SAMPLE_ROWS = 2500  # labelled documents that the classifier learns from
ROUNDS = 30
TOLERANCE = 1e-5


def domain_of(labels: DataFrame, id_col: str) -> DataFrame:
    """(id, domain number) of the labelled documents; rows with a null label and ids labelled twice differently
    don't count."""
    number = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    known = labels.filter(F.col("quality").isNotNull() & F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    return known.select(F.col(id_col).alias("_id"), number.alias("_domain")).groupBy("_id").agg(
        F.min("_domain").alias("_domain"), F.max("_domain").alias("_most")).filter("_domain = _most").drop("_most")


def fit_domains(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights of the domain classifier, from the labelled documents with the smallest hashes of their ids."""
    chosen = domain_of(labels, id_col).orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), "_id").dropDuplicates(["_id"]).select("_id", "_text", "_domain").toArrow()
    rows = rows.sort_by("_id")
    sample = classifier.bag(rows.column("_text").combine_chunks())
    return classifier.train(sample, rows.column("_domain").to_numpy(), len(DOMAINS))


def posteriors(docs: DataFrame, weights: np.ndarray, text_col: str, tokens_col: str, shares_col: str,
               keep_text: bool) -> DataFrame:
    """``docs`` (with or without its text), the number of words of each text and its domain posteriors."""
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType([*kept, T.StructField(tokens_col, T.LongType()), T.StructField(shares_col, T.ArrayType(T.DoubleType()))])
    names = [f.name for f in kept]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(at, PART_ROWS)
                words = classifier.bag(part.column(part.schema.get_field_index(text_col)))
                shares = classifier.softmax(classifier.logits(words, weights)).astype(np.float64)
                lists = pa.ListArray.from_arrays(np.arange(0, shares.size + 1, shares.shape[1], dtype=np.int32), shares.ravel())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(n)) for n in names), pa.array(words.sizes.astype(np.int64)), lists],
                    [*names, tokens_col, shares_col])

    return docs.mapInArrow(add, schema)


def _replay(shares: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after the given gradient steps: each is followed by the projection on what is not negative."""
    rate = np.ones(len(shares))
    for step in steps:
        rate = np.maximum(0.0, rate - shares @ step)
    return rate


def _shares(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index(name))
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def solve(members: DataFrame, targets: tuple[float, ...], tokens_col: str, shares_col: str, rounds: int = ROUNDS,
          tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """The steps of projected-gradient least squares on |sum of rate x tokens x posteriors / all tokens - targets|^2.

    The residual is measured in the metric of M = sum of tokens x p p' (domains x domains) over the documents whose
    rate is above zero, and documents are scaled by their tokens. So a step is exact as long as no rate meets zero,
    documents with equal posteriors get equal rates, and a few steps settle the ones that do meet it; a step that does
    not come closer is halved. A rate depends on the document's posteriors and the steps so far only: a round replays
    them and adds up the totals where the rows are; nothing else is kept between rounds.
    """
    k = len(targets)
    goal = np.asarray(targets) / sum(targets)

    def total(steps: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
        """All tokens, rated tokens by domain, M."""
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(1 + k + k * k)
            for batch in batches:
                tokens = batch.column(batch.schema.get_field_index(tokens_col)).to_numpy().astype(np.float64)
                shares = _shares(batch, shares_col)
                weighted = shares * tokens[:, None]
                rates = _replay(shares, steps)
                sums[0] += tokens.sum()
                sums[1:1 + k] += rates @ weighted
                used = rates > 0
                sums[1 + k:] += (shares[used].T @ weighted[used]).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], ["place", "value"])

        parts = members.select(tokens_col, shares_col).mapInArrow(add, "place long, value double")
        out = np.zeros(1 + k + k * k)
        for row in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():  # 13 numbers for three domains
            out[row["place"]] = row["value"]
        return out[0], out[1:1 + k], out[1 + k:].reshape(k, k)

    tokens, rated, metric = total([])
    if not tokens:
        return []
    steps: list[np.ndarray] = []
    miss = rated / tokens - goal
    size = 1.0
    for _ in range(rounds):
        if np.abs(miss).max() < tolerance:
            break
        scaled = metric / tokens
        scaled += np.eye(k) * (np.trace(scaled) * 1e-6 + 1e-12)
        step = size * np.linalg.solve(scaled, miss)
        tokens, rated, tried = total([*steps, step])
        after = rated / tokens - goal
        if np.linalg.norm(after) < np.linalg.norm(miss):
            steps.append(step)
            miss, metric, size = after, tried, min(1.0, 2 * size)
        else:
            size /= 2
    return steps


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        targets: tuple[float, ...] = TARGETS, keep_text: bool = False) -> DataFrame:
    """``docs`` (without its text unless asked for) with n_tokens, the domain posteriors p_* and ``rate``.

    ``rate`` is how many times a document is to be used in expectation. Null and empty texts have no tokens and the
    posteriors of an empty text. Rows are rated each on their own, repeated ones alike. Without labels all
    posteriors are equal; targets that the documents can't reach are met as closely as possible.
    """
    weights = fit_domains(docs, labels, id_col, text_col)
    tokens_col, shares_col = fresh(docs, "n_tokens"), fresh(docs, "shares")
    members = cut_lineage(posteriors(docs.select(text_col) if keep_text else docs, weights, text_col, tokens_col,
                                     shares_col, False))
    steps = solve(members, targets, tokens_col, shares_col)
    rated = posteriors(docs, weights, text_col, tokens_col, shares_col, True) if keep_text else members
    rate_col = fresh(docs, "rate")
    schema = T.StructType([*rated.schema.fields, T.StructField(rate_col, T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rates = _replay(_shares(batch, shares_col), steps)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates)], [*batch.schema.names, rate_col])

    rated = rated.mapInArrow(add, schema)
    kept = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text_col]
    return rated.select(*kept, tokens_col, *(
        F.col(shares_col)[i].alias(fresh(docs, f"p_{name}")) for i, name in enumerate(DOMAINS)), rate_col)
