"""K-means of many models at once: every pass over the rows serves all of them.

The centres are model parameters and go to the tasks with the function; a task returns a few rows per
model, which Spark adds up. Starts are drawn as in k-means||: some steps draw rows by their squared
distance to the centres so far, the drawn rows are weighted by the rows nearest to them and reduced to
k by weighted k-means++ on the driver. A step draws an exact number of rows, each with an exponential
key over its weight, so it needs no pass for the sum of the weights and its result is bounded.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import column

INIT_STEPS = 2
#: A model is done when no centre moves farther.
TOLERANCE = 1e-4
LOCAL_ITERATIONS = 30
BLOCK_BYTES = 1 << 17

# tasks need numpy and pyarrow, but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Wanted:
    """A model to fit: the parts whose rows it learns from, its clusters and its iterations at most."""

    parts: frozenset[int]
    k: int
    iterations: int


@dataclass
class Centres:
    """Fitted centres, one a row, and the number of iterations."""

    centres: np.ndarray
    iterations: int = 0


#: What a pass works on: number of the model, its parts, its centres (None before the first draw).
Task = tuple[int, frozenset[int], np.ndarray | None]


def part_table(rows: DataFrame, vector: str, part: str) -> DataFrame:
    """``(at, v)``: the part of each row and its vector, given as an array or a Spark vector, as an array.

    Of a packed table ``(at, v, width)``, a block a row.
    """
    at = column(part).cast("int").alias("at")
    kind = rows.schema[vector].dataType.typeName()
    if kind == "binary":
        return rows.select(at, column(vector).alias("v"), "width")
    return rows.select(at, (column(vector) if kind == "array" else vector_to_array(column(vector))).alias("v"))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(part, its rows as a matrix) of every batch of a part table; rows without a part are in part -1."""
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
        if batch.num_columns == 3:
            for part, block, width in zip(parts, batch.column(1), batch.column(2)):
                yield int(part), np.frombuffer(block.as_buffer()).reshape(-1, width.as_py())
            continue
        rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        if not np.isfinite(rows).all():
            raise ValueError("features must not be null, NaN or infinite")
        for part in np.unique(parts):
            yield int(part), rows[parts == part]


def pack(rows: DataFrame, vector: str, part: str) -> DataFrame:
    """``(part, vector, width)``: blocks of vectors of one part as bytes, so that many passes read them at little cost."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, matrix in blocks(batches):
            many = max(1, BLOCK_BYTES // (8 * max(1, matrix.shape[1])))
            cut = [np.ascontiguousarray(matrix[i:i + many]).tobytes() for i in range(0, len(matrix), many)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([at] * len(cut), pa.int32()), pa.array(cut, pa.binary()),
                 pa.array([matrix.shape[1]] * len(cut), pa.int32())], [part, vector, "width"])
    name = part.replace("`", "``"), vector.replace("`", "``")
    return part_table(rows, vector, part).mapInArrow(run, f"`{name[0]}` int, `{name[1]}` binary, width int")


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of the nearest centre of each row, the lowest on ties."""
    # measured from amid the centres, so that a common offset costs no digits
    middle = centres.mean(axis=0)
    moved = centres - middle
    half = (moved * moved).sum(axis=1) / 2
    far = (rows - middle) @ moved.T
    np.subtract(half, far, out=far)
    return np.argmin(far, axis=1)


def square_distance(rows: np.ndarray, centres: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """To the nearest centre, or to the one given for each row."""
    gaps = rows - centres[nearest(rows, centres) if own is None else own]
    return np.einsum("ij,ij->i", gaps, gaps)


def _drawing(tasks: Sequence[Task], many: Sequence[int], seed: Sequence[int]) -> Callable:
    """Rows ``(model, key, v)``: the ``many`` rows of a model with the smallest keys in the task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([*seed, TaskContext.get().partitionId()])
        best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(tasks)
        for part, rows in blocks(batches):
            for i, (_, parts, centres) in enumerate(tasks):
                if part not in parts:
                    continue
                keys = rng.exponential(size=len(rows))
                if centres is not None:
                    cost = square_distance(rows, centres)
                    keys = np.divide(keys, cost, out=np.full(len(rows), np.inf), where=cost > 0)
                known = best[i]
                limit = np.inf if known is None or len(known[0]) < many[i] else known[0].max()
                chosen = np.flatnonzero(keys < limit)
                if len(chosen) > many[i]:
                    chosen = chosen[np.argpartition(keys[chosen], many[i] - 1)[:many[i]]]
                if len(chosen):
                    keys, found = keys[chosen], rows[chosen]
                    if known is not None:
                        keys, found = np.concatenate([known[0], keys]), np.concatenate([known[1], found])
                    first = np.argsort(keys, kind="stable")[:many[i]]
                    best[i] = keys[first], found[first]
        for (model, _, _), known in zip(tasks, best):
            if known is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([model] * len(known[0]), pa.int32()), pa.array(known[0]),
                     pa.array(known[1].tolist(), pa.list_(pa.float64()))], ["model", "key", "v"])
    return run


def _adding(tasks: Sequence[Task]) -> Callable:
    """Rows ``(model, cluster, n, v)``: number and sum of the task's rows that are nearest to each centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros_like(centres) for _, _, centres in tasks]
        sizes = [np.zeros(len(centres), np.int64) for _, _, centres in tasks]
        for part, rows in blocks(batches):
            for i, (_, parts, centres) in enumerate(tasks):
                if part in parts:
                    own = nearest(rows, centres)
                    sizes[i] += np.bincount(own, minlength=len(centres))
                    sums[i] += (own == np.arange(len(centres))[:, None]).astype(np.float64) @ rows
        for (model, _, centres), n, v in zip(tasks, sizes, sums):
            yield pa.RecordBatch.from_arrays(
                [pa.array([model] * len(n), pa.int32()), pa.array(range(len(n)), pa.int32()), pa.array(n),
                 pa.array(v.tolist(), pa.list_(pa.float64()))], ["model", "cluster", "n", "v"])
    return run


def reduce_candidates(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Weighted k-means++ and Lloyd's iterations over a few different points; all of them when there are k at most."""
    if len(points) <= k:
        return points
    weights = np.maximum(weights, 1).astype(np.float64)
    centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
    while len(centres) < k:
        share = weights * square_distance(points, centres)
        if not share.sum() > 0:
            break
        centres = np.concatenate([centres, points[[rng.choice(len(points), p=share / share.sum())]]])
    own = None
    for _ in range(LOCAL_ITERATIONS):
        before, own = own, nearest(points, centres)
        if before is not None and (before == own).all():
            break
        for j in range(len(centres)):
            if (own == j).any():
                centres[j] = np.average(points[own == j], axis=0, weights=weights[own == j])
    return centres


def fit_centres(rows: DataFrame, vector: str, part: str, wanted: Sequence[Wanted], seed: int = 1) -> list[Centres]:
    """The centres of all wanted models over the staged ``rows``, which have a vector and the number of their part, or are
    packed.

    The draws depend on the seed and on the rows of a task. A model over fewer different rows than k has
    fewer centres.
    """
    table = part_table(rows, vector, part)

    def draw(tasks: Sequence[Task], many: Sequence[int], step: int) -> dict[int, np.ndarray]:
        most = max(many)
        best = W.partitionBy("model").orderBy("key", "v")
        # a few rows a task and model
        found = (table.mapInArrow(_drawing(tasks, many, [seed, step]), "model int, key double, v array<double>")
                 .withColumn("place", F.row_number().over(best)).where(F.col("place") <= most))
        out: dict[int, list] = {}
        for r in found.orderBy("model", "place").collect():
            out.setdefault(r["model"], []).append(r["v"])
        return {t[0]: np.array(out[t[0]][:n]) for t, n in zip(tasks, many) if t[0] in out}

    def add(tasks: Sequence[Task]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Sizes and sums of the clusters of each model."""
        found = (table.mapInArrow(_adding(tasks), "model int, cluster int, n bigint, v array<double>")
                 .groupBy("model", "cluster").agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("v")).alias("v")))
        out = {m: (np.zeros(len(c), np.int64), np.zeros_like(c)) for m, _, c in tasks}
        # one row per centre
        for r in found.collect():
            out[r["model"]][0][r["cluster"]] = r["n"]
            out[r["model"]][1][r["cluster"]] = r["v"].toArray()
        return out

    # models of the same parts begin at the same row
    groups = sorted({w.parts for w in wanted}, key=sorted)
    firsts = draw([(g, parts, None) for g, parts in enumerate(groups)], [1] * len(groups), 0)
    if len(firsts) < len(groups):
        raise ValueError("a k-means model has no rows to learn from")
    candidates = [firsts[groups.index(w.parts)] for w in wanted]
    for step in range(1, INIT_STEPS + 1):
        drawn = draw([(i, w.parts, candidates[i]) for i, w in enumerate(wanted)], [2 * w.k for w in wanted], step)
        candidates = [np.concatenate([c, drawn[i]]) if i in drawn else c for i, c in enumerate(candidates)]
    candidates = [np.unique(c, axis=0) for c in candidates]
    weights = add([(i, w.parts, candidates[i]) for i, w in enumerate(wanted)])
    fitted = [Centres(reduce_candidates(candidates[i], weights[i][0], w.k, np.random.default_rng([seed, i])))
              for i, w in enumerate(wanted)]

    moving = {i for i, w in enumerate(wanted) if w.iterations > 0}
    while moving:
        found = add([(i, wanted[i].parts, fitted[i].centres) for i in sorted(moving)])
        for i, (n, sums) in found.items():
            # a cluster without rows stays where it is
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], fitted[i].centres)
            gaps = ((new - fitted[i].centres) ** 2).sum(axis=1)
            fitted[i] = Centres(new, fitted[i].iterations + 1)
            if (gaps <= TOLERANCE ** 2).all() or fitted[i].iterations >= wanted[i].iterations:
                moving.discard(i)
    return fitted


def centres_model(rows: DataFrame, vector: str, centres: np.ndarray, k: int) -> KMeansModel:
    """A Spark model of given centres: they are the only rows that it begins with, and no iteration follows."""
    spark = rows.sparkSession
    few = spark.createDataFrame([(c,) for c in centres.tolist()], "c array<double>").coalesce(1)
    return KMeans(featuresCol=vector, k=k, seed=1, initMode="random", maxIter=0).fit(
        few.select(array_to_vector("c").alias(vector)))
