"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries are whole numbers (64ths, shifted), so counts, sums and the scatter are exact, whatever the partitioning: tasks
centre their vectors on the rounded mean, multiply, and send one matrix each; what the rounding left is taken off
exactly. The driver gets the summed matrix only, whose size is the square of the dimension, never that of the data.

The scatter C is factored as L L' with the largest remaining variance as pivot, and the columns of L are rotated pair by
pair until they are orthogonal. Then L J = U S: the squared norms of the rotated columns are the eigenvalues, the
normalised columns are the components. C = (L J)(L J)', so nothing is squared again and small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 32
SHIFT = 1_000_000
EXACT = 2.0**53  # whole numbers up to here are exact as doubles
SWEEPS = 60


def _whole(embedding: str):
    """floor(64 c) + 1,000,000 of each entry."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * 64) + SHIFT)


def fit_list(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows whose vector and entries are neither null nor infinite nor NaN."""
    finite = lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False))
    kept = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    return kept.filter(F.coalesce(F.forall("v", finite), F.lit(False))).select("id", _whole("v").alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """(n, sum of each dimension) of the vectors with the most frequent number of entries (of equals, the larger)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                x = _matrix(batch.column(0).filter(pa.array(sizes == d))) if d else np.zeros((int((sizes == 0).sum()), 0))
                n, s = total.get(d, (0, np.zeros(d, object)))
                total[d] = n + len(x), s + _exact_sum(x)
        for d, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d], pa.int32()), pa.array([n], pa.int64()), pa.array([[str(v) for v in s]], pa.list_(pa.string()))],
                ["d", "n", "s"])

    parts = fit.select("x").mapInArrow(add, "d int, n long, s array<string>")
    sizes = parts.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None or not sizes["d"]:
        return 0, []
    by_place = parts.filter(F.col("d") == sizes["d"]).select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    return sizes["n"], [int(r["v"]) for r in by_place.orderBy("i").collect()]


def _exact_sum(x: np.ndarray) -> np.ndarray:
    if not x.size or float(np.abs(x).max()) * len(x) < 2.0**62:
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def _exact_product(y: np.ndarray) -> np.ndarray:
    """y'y in whole numbers."""
    most = float(np.abs(y).max()) if y.size else 0.0
    if most < 2.0**26:
        step = max(1, int(EXACT / max(1.0, most * most)))
        parts = [y[i:i + step].astype(np.float64) for i in range(0, len(y), step)]
        return sum((p.T @ p).astype(np.int64).astype(object) for p in parts)
    y = y.astype(object)
    return y.T @ y


def scatter(fit: DataFrame, n: int, s: list[int]) -> np.ndarray:
    """Exact sum over vectors of (n x - S)(n x - S)' / n, a matrix of whole numbers."""
    d = len(s)
    centre = np.array([(2 * v + n) // (2 * n) for v in s], np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        seen = False
        for batch in batches:
            if batch.num_rows:
                total = total + _exact_product(_matrix(batch.column(0)) - centre)
                seen = True
        for i in range(d if seen else 0):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([[str(v) for v in total[i, i:]]], pa.list_(pa.string()))], ["i", "row"])

    parts = fit.filter(F.size("x") == d).select("x").mapInArrow(multiply, "i int, row array<string>")
    summed = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # d (d + 1) / 2 rows
    out = np.zeros((d, d), object)
    left = [v - n * int(c) for v, c in zip(s, centre)]  # sums of the centred vectors: what the rounding left
    for i, j, v in summed:
        out[i, i + j] = out[i + j, i] = n * int(v) - left[i] * left[i + j]
    return out


def pivoted_cholesky(c: np.ndarray) -> np.ndarray:
    """L with L L' = c, rows in c's order, each column made for the largest variance that is left; as many as c's rank."""
    left = np.array(c, np.float64)
    d = len(left)
    columns: list[np.ndarray] = []
    floor = left.diagonal().max(initial=0.0) * d * np.finfo(float).eps
    used = np.zeros(d, bool)
    for _ in range(d):
        remaining = np.where(used, -1.0, left.diagonal())
        p = int(remaining.argmax())
        if remaining[p] <= floor:
            break
        column = np.where(used, 0.0, left[:, p]) / np.sqrt(remaining[p])
        used[p] = True
        columns.append(column)
        left = left - np.outer(column, column)
    return np.array(columns).T.reshape(d, len(columns))


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of factor factor', falling: columns rotated until they are orthogonal.

    All pairs meet once in a sweep, in rounds of pairs that have no column in common (as in a tournament).
    """
    a = np.array(factor, np.float64)
    k = a.shape[1]
    players = list(range(k + k % 2))
    eps = np.finfo(float).eps
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(players) - 1):
            half = len(players) // 2
            pairs = [(p, q) for p, q in zip(players[:half], players[:half - 1:-1]) if p < k and q < k]
            players = [players[0], players[-1], *players[1:-1]]
            if not pairs:
                continue
            p, q = np.array(pairs).T
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            scale = np.sqrt(xx * yy)
            turn = np.abs(xy) > eps * scale
            worst = max(worst, float((np.abs(xy)[turn] / scale[turn]).max(initial=0.0)))
            zeta = np.where(turn, (yy - xx) / np.where(turn, 2 * xy, 1.0), 0.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            cos = 1 / np.hypot(1.0, t)
            a[:, p], a[:, q] = cos * (x - t * y), cos * (y + t * x)
        if worst <= 4 * eps * max(1.0, np.sqrt(len(a))):
            break
    norms = np.sqrt((a * a).sum(0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, a[:, order] / norms[order]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Vectors that are null or hold null or non-finite entries are left out, and so are vectors with another number of
    entries than most have. Repeated rows, null and repeated ids are rows of their own; other columns don't matter. A
    component has a positive eigenvalue: fewer than ``components`` if the rank is lower, none (no rows) if all vectors
    are equal or there are none. ``deviation`` is null where it doesn't fit a long.
    """
    id_type = df.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error"))])
    fit = fit_list(df, id_col, vector_col)
    n, s = sums(fit)
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    exact = scatter(fit, n, s)
    scale = int(exact.diagonal().max())
    # as a share of the largest variance: whole numbers of any size become doubles with one rounding
    share = np.array([[int(v) / scale for v in row] for row in exact]) if scale else np.zeros(exact.shape)
    values, vectors = one_sided_jacobi(pivoted_cholesky(share))
    values, vectors = values[:components], vectors[:, :components]
    explained = (values / (sum(int(v) for v in exact.diagonal()) / scale)).tolist() if scale else []
    k, d = len(values), len(s)
    variance = scale / n**2  # of the pivot
    project = vectors / np.sqrt(values * variance)
    centre = np.array([(2 * v + n) // (2 * n) for v in s], np.int64)
    left = [v - n * int(c) for v, c in zip(s, centre)]
    rest = np.array([v / n for v in left])  # S / n - centre
    kept = fit.filter(F.size("x") == d)

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            if batch.num_rows:
                w = (_matrix(batch.column(0)) - centre - rest) @ project
                w = np.column_stack([w, np.ones(len(w))])
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["m"])

    moments = kept.select("x").mapInArrow(outer, "m array<double>").select(F.posexplode("m").alias("i", "v"))
    moments = moments.groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()  # (k + 1)^2 rows
    m = np.array([r["v"] for r in moments]).reshape(k + 1, k + 1)
    covariance = m[:k, :k] / n - np.outer(m[:k, k], m[:k, k]) / n**2
    error = float(np.abs(covariance - np.eye(k)).max(initial=0.0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            y = _matrix(batch.column(1)) - centre
            w = (y - rest) @ project
            at = np.repeat(np.arange(len(y)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                pa.array(np.full(len(at), n, np.int64)), pa.array(_deviation(y, n, left), pa.int64()).take(pa.array(at)),
                pa.array(w.ravel()), pa.array(np.tile(explained, len(y))), pa.array(np.full(len(at), error)),
            ], [f.name for f in schema])

    return kept.mapInArrow(rows, schema)


def _deviation(y: np.ndarray, n: int, left: list[int]) -> list[int | None]:
    """Sum over dimensions of (n y - left)^2, exact; null beyond a long."""
    if (float(np.abs(y).max(initial=0)) * n + max(map(abs, left))) ** 2 * y.shape[1] < 2.0**62:
        off = y * n - np.array(left, np.int64)
        return (off * off).sum(axis=1).tolist()
    off = y.astype(object) * n - np.array(left, object)
    return [v if v < 2**63 else None for v in (off * off).sum(axis=1)]
