"""Embedding whitening: QDWH spectral divide-and-conquer of the covariance, then a broadcast projection.

Vectors become whole numbers, each different one is kept once, and Spark adds up their exact sums
and their centred second moments. The covariance, dimensions times dimensions, comes to the driver.
There the polar factor of the shifted covariance, by the dynamically weighted Halley iteration,
gives the projector onto the eigenvectors above the shift; the two invariant subspaces it parts are
split in the same way until each is one component. The components go to every task, which
projects its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col

#: Steps of one unit of an entry.
SCALE = 256
COMPONENTS = 4
_EPS = float(np.finfo(float).eps)
_LONG = 2 ** 63


# ------------------------------------------------------------------ spectral divide-and-conquer

def polar_factor(a: np.ndarray, rounds: int = 12) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH.

    The iteration maps each singular value to 1 and keeps its sign. Its weights follow a lower bound of
    the least singular value; that bound starts at the rounding level, which takes six rounds or seven.
    Singular values below it may end under 1, which the caller sees from the factor's square.
    """
    size = len(a)
    x, low = a / max(float(np.linalg.norm(a)), np.finfo(float).tiny), _EPS
    for _ in range(rounds):
        square = low * low
        step = (4 * (1 - square) / (square * square)) ** (1 / 3)
        root = np.sqrt(1 + step)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * step + 8 * (2 - square) / (square * root), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # by QR, which stays accurate for large weights
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(size)]))[0]
            new = (wb / wc) * x + ((wa - wb / wc) / np.sqrt(wc)) * (q[:size] @ q[size:].T)
        else:
            lower = np.linalg.cholesky(np.eye(size) + wc * (x.T @ x))
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        moved, x = float(np.linalg.norm(new - x)), (new + new.T) / 2
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        if moved < _EPS ** (1 / 3) and low > 1 - 10 * _EPS:
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Places inside the spectrum: between neighbouring diagonal entries, from the middle outwards.

    The least and the largest diagonal entry enclose no more than the spectrum does, so each place
    between them has eigenvalues on both sides. Equal entries leave only their own value.
    """
    diagonal = np.sort(np.diag(a))
    gaps = [i for i in range(len(diagonal) - 1) if diagonal[i + 1] > diagonal[i]]
    for i in sorted(gaps, key=lambda i: abs(2 * i + 2 - len(diagonal))):
        yield float(diagonal[i] + diagonal[i + 1]) / 2
    spread = float(np.linalg.norm(a - np.diag(np.diag(a)))) / len(a)
    for share in (0.0, 0.05, -0.05, 0.11, -0.11, 0.23, -0.23, 0.47, -0.47):
        yield float(np.median(diagonal)) + share * spread


def split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift, or None when all eigenvalues agree.

    ``scale`` is the size of the whole matrix: blocks that differ from a multiple of the identity by
    rounding only are not parted further, any basis of theirs is one of eigenvectors.
    """
    size = len(a)
    rest = a - np.eye(size) * (np.trace(a) / size)
    if np.linalg.norm(rest) <= 4 * size * _EPS * scale:
        return None
    start = np.random.default_rng(size).standard_normal((size, size))
    best, left = None, np.inf
    for shift in _shifts(a):
        factor = polar_factor(a - shift * np.eye(size))
        projector = (factor + np.eye(size)) / 2
        rank = int(round(float(np.trace(projector))))
        if not 0 < rank < size or np.linalg.norm(factor @ factor - np.eye(size)) > 1e-8:
            continue
        basis = np.linalg.qr(projector @ start[:, :rank])[0]
        basis = np.linalg.qr(projector @ basis, mode="complete")[0]
        above, below = basis[:, :rank], basis[:, rank:]
        tie = float(np.linalg.norm(below.T @ a @ above))
        if tie < left:
            best, left = (above, below), tie
        if tie <= 50 * size * _EPS * scale:
            break
    return best


def spectral_components(matrix: np.ndarray, count: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Subspaces are split until each has one dimension or one eigenvalue; those that lie wholly below
    the wanted ones are left whole. The sign is fixed by making the largest entry of a vector positive.
    """
    matrix = (matrix + matrix.T) / 2
    size = len(matrix)
    count = size if count is None else min(count, size)
    scale = float(np.linalg.norm(matrix))
    done: list[np.ndarray] = []
    todo = [np.eye(size)]  # highest on top
    while todo and len(done) < count:
        basis = todo.pop()
        parts = split(basis.T @ matrix @ basis, scale) if basis.shape[1] > 1 else None
        if parts is None:
            done += list(basis.T)
        else:
            above, below = parts
            todo += [basis @ below, basis @ above]
    vectors = np.array(done).reshape(-1, size)[:, :size]
    values = np.einsum("ij,jk,ik->i", vectors, matrix, vectors)
    order = np.argsort(-values, kind="stable")[:count]
    values, vectors = values[order], vectors[order]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), np.finfo(float).tiny)
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return values, (vectors * signs[:, None]).T


# ------------------------------------------------------------------ statistics over all vectors

@dataclass
class Whitening:
    """Number and exact sums of the different vectors, components as columns, their eigenvalues and shares."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None


def usable(vector: Column, scale: int = SCALE) -> Column:
    """Whether a vector is there, has entries, and all of them are finite and within a long when scaled."""
    entry = lambda c: c.cast("double") * F.lit(float(scale))
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < F.lit(float(_LONG))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) of every entry as long; a negative zero becomes zero."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(0).cast("long"))


def _rows(batch: pd.Series, size: int) -> np.ndarray:
    return np.concatenate([np.asarray(v, np.int64) for v in batch]).reshape(-1, size) if len(batch) else np.empty((0, size), np.int64)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S without rounding: longs where they hold it, else Python's whole numbers."""
    if n * int(np.abs(x.astype(float)).max(initial=0)) * 2 + 2 * max(map(abs, sums), default=0) + 2 < _LONG // 2:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(deviations: np.ndarray) -> list[int | None]:
    """Exact sums of squares by row; None where a long can't hold it."""
    if deviations.dtype != object and deviations.shape[1] * int(np.abs(deviations).max(initial=0)) ** 2 < _LONG:
        return (deviations * deviations).sum(axis=1).tolist()
    total = [sum(int(v) ** 2 for v in row) for row in deviations]
    return [t if t < _LONG else None for t in total]


def exact_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension: 32-bit halves are added apart, so no sum overflows."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = _rows(batch["x"], size)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pd.DataFrame({"i": np.arange(size), "n": n, "high": high, "low": low})

    whole = {name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("n", "high", "low")}
    found = fit.mapInPandas(add, "i int, n long, high long, low long").groupBy("i").agg(*whole.values()).collect()
    sums = [0] * size
    for r in found:
        sums[r["i"]] = int(r["high"]) * 2 ** 32 + int(r["low"])
    return (int(found[0]["n"]) if found else 0), sums


def covariance(fit: DataFrame, size: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor n. Rows are centred by the exact sums before they are multiplied."""
    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            centred = _deviations(_rows(batch["x"], size), n, sums).astype(float) / n
            total += centred.T @ centred
        for i in range(size):
            yield pd.DataFrame({"i": i, "j": np.arange(i, size), "v": total[i, i:]})

    out = np.zeros((size, size))
    for i, j, v in fit.mapInPandas(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = out[j, i] = v / n
    return out


def identity_gap(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of (covariance of the whitened fit list - identity), measured over the list."""
    size, k = len(model.sums), len(model.values)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            w = _projected(_deviations(_rows(batch["x"], size), model.n, model.sums), model)
            mean = w.mean(axis=0)
            moment = (w - mean).T @ (w - mean)
            yield pd.DataFrame([(i, j, len(w), len(w) * mean[i], len(w) * mean[j], moment[i, j],
                                 len(w) * mean[i] * mean[j]) for i in range(k) for j in range(k)],
                               columns=["i", "j", "n", "si", "sj", "within", "between"])

    parts = fit.mapInPandas(multiply, "i int, j int, n long, si double, sj double, within double, between double")
    gap = 0.0
    for r in parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "within", "between")]).collect():
        entry = (r["within"] + r["between"] - r["si"] * r["sj"] / r["n"]) / r["n"]
        gap = max(gap, abs(entry - (r["i"] == r["j"])))
    return gap


def _projected(deviations: np.ndarray, model: Whitening) -> np.ndarray:
    return (deviations.astype(float) / model.n) @ (model.vectors / np.sqrt(model.values))


def fit_whitening(df: DataFrame, vector_col: str, components: int = COMPONENTS, scale: int = SCALE) -> Whitening:
    """Fit on the different vectors of ``df`` after scaling, each once; every one of them is used.

    Vectors that are null, empty, or hold null, non-finite or too large entries are left out, and so are
    those whose length is not the one that most different vectors have (of several, the longest).
    Components without variance have no whitening: they are left out, so that equal vectors or
    none give a model without components. Different vectors are found by one shuffle after a
    map-side combine and staged; the driver gets sums and the covariance, both sized by dimensions.
    """
    vector = col(vector_col)
    fit = stage(df.where(usable(vector, scale)).select(scaled(vector, scale).alias("x")).distinct(), "whitening")
    lengths = fit.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)), np.empty(0))
    size = lengths["size"]
    fit = fit.where(F.size("x") == size)
    n, sums = exact_sums(fit, size)
    matrix = covariance(fit, size, n, sums)
    values, vectors = spectral_components(matrix, components)
    kept = values > 16 * size * _EPS * max(float(np.trace(matrix)), np.finfo(float).tiny)
    values, vectors = values[kept], vectors[:, kept]
    model = Whitening(n, sums, values, vectors, values / np.trace(matrix) if len(values) else values)
    model.identity_error = identity_gap(fit, model) if len(values) else None
    return model


def whitened_rows(df: DataFrame, id_col: str, vector_col: str, model: Whitening, scale: int = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per usable row and component.

    Repeated rows and null ids are rows like others; further columns are ignored. ``deviation`` is exact,
    and null where a long can't hold it. A model without components gives no rows.
    """
    size, k = len(model.sums), len(model.values)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            deviations = _deviations(_rows(batch["x"], size), model.n, model.sums)
            yield pd.DataFrame({
                "vec_id": batch["vec_id"].repeat(k).to_numpy(),
                "component": np.tile(np.arange(1, k + 1), len(batch)), "n": model.n,
                "deviation": pd.Series(_squares(deviations), dtype="Int64").repeat(k).to_numpy(),
                "whitened": _projected(deviations, model).ravel(),
                "explained": np.tile(model.explained, len(batch)), "identity_error": model.identity_error})

    vector = col(vector_col)
    rows = df.where(usable(vector, scale) & (F.size(vector) == size) & F.lit(k > 0)).select(
        col(id_col).alias("vec_id"), scaled(vector, scale).alias("x"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInPandas(project, f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                     "explained double, identity_error double")


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``whitened_rows`` of ``df`` under the whitening fitted on its own different vectors."""
    return whitened_rows(df, id_col, vector_col, fit_whitening(df, vector_col, components))
