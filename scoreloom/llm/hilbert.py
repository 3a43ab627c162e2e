"""Approximate nearest neighbours by inner product along shifted Hilbert curves.

Vectors get one more component that makes all norms equal, so that the largest inner product is the
nearest point. Each curve looks at a few axes of a random rotation, shifted at random, and puts all
vectors in the order of their Hilbert keys. The order is cut into ranges of about ``RANGE_ROWS``
vectors; a query is compared with the ranges around its own key on every curve, the exact inner
products of these windows are merged, and the best are kept. How wide the windows are is measured on
a sample of the vectors, so that they are as narrow as the data allow for the recall asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col, shuffle_partitions

CURVES = 20
AXES = 8
BITS = 7
#: Vectors in a range.
RANGE_ROWS = 1024
#: Vectors that range borders, shifts and windows are fitted on at most (about; up to twice as many).
SAMPLE = 20_000
#: Share of the sample's nearest vectors that its windows must hold, and the sample's queries.
RECALL = 0.95
SAMPLE_QUERIES = 256
#: Queries that meet a range in one task at most, on average.
QUERY_ROWS = 4096
SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points, one row each, by Skilling's transposition."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[n - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """Rotations, shifts and range borders of all curves."""

    def __init__(self, dims: int, norm: float, curves: int = CURVES, axes: int = AXES, bits: int = BITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = dims + 1
        self.axes, self.bits, self.norm = min(axes, size), bits, norm
        turned = []
        while sum(t.shape[1] for t in turned) < curves * self.axes:
            turned.append(np.linalg.qr(rng.normal(size=(size, size)))[0][:, :size - size % self.axes])
        self.rotation = np.concatenate(turned, axis=1)[:, :curves * self.axes]
        self.shift = rng.random(curves * self.axes)
        self.curves = curves
        self.low = self.step = self.borders = None

    def _lifted(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        norms = np.sqrt((vectors ** 2).sum(axis=1))
        if query:
            return np.hstack([vectors * (self.norm / norms)[:, None], np.zeros((len(vectors), 1))])
        return np.hstack([vectors, np.sqrt(np.maximum(self.norm ** 2 - norms ** 2, 0))[:, None]])

    def keys(self, vectors: np.ndarray, ids: np.ndarray, query: bool) -> np.ndarray:
        """A key per vector and curve; the lowest bits come from the id and part equal places."""
        at = self._lifted(vectors, query) @ self.rotation
        cells = np.clip((at - self.low) / self.step, 0, (1 << self.bits) - 1).astype(np.int64)
        mixed = (ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
        return np.stack([(hilbert_keys(cells[:, c * self.axes:(c + 1) * self.axes], self.bits) << 6)
                         + mixed.astype(np.int64) for c in range(self.curves)], axis=1)

    def fit(self, vectors: np.ndarray, ids: np.ndarray, ranges: int) -> Curves:
        """Place the grid over a sample, shifted by up to a tenth of it, and cut equal ranges."""
        at = self._lifted(vectors, False) @ self.rotation
        mean, spread = at.mean(axis=0), np.maximum(at.std(axis=0), 1e-12)
        self.low = mean - (3.5 + self.shift * 0.8) * spread
        self.step = 7.8 * spread / (1 << self.bits)
        keys = np.sort(self.keys(vectors, ids, False), axis=0)
        self.borders = keys[(np.arange(1, ranges) * len(keys) // ranges)]
        return self

    def window(self, vectors: np.ndarray, ids: np.ndarray, k: int, recall: float) -> float:
        """The least share of a sample that windows must span to hold ``recall`` of its queries' ``k`` nearest.

        The nearest of a query come from all products with the sample. Each lies so many places from the query
        on its best curve; a quantile of these distances is half the window. In a larger table the nearest
        vectors are nearer, so the same share holds no less.
        """
        n = len(vectors)
        k = min(k, n - 1)
        if k < 1:
            return 1.0
        asked = np.random.default_rng(SEED).permutation(n)[:SAMPLE_QUERIES]
        scores = vectors[asked] @ vectors.T
        scores[np.arange(len(asked)), asked] = -np.inf
        top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        keys, own = self.keys(vectors, ids, False), self.keys(vectors[asked], ids[asked], True)
        away = np.full(top.shape, n)
        for c in range(self.curves):
            order = np.argsort(keys[:, c])
            place = np.empty(n, np.int64)
            place[order] = np.arange(n)
            at = np.searchsorted(keys[order, c], own[:, c])
            away = np.minimum(away, np.abs(place[top] - at[:, None]))
        return min(1.0, 2 * float(np.quantile(away, recall, method="higher")) / n)

    def ranges(self, vectors: np.ndarray, ids: np.ndarray, query: bool) -> np.ndarray:
        keys = self.keys(vectors, ids, query)
        return np.stack([np.searchsorted(self.borders[:, c], keys[:, c], side="right")
                         for c in range(self.curves)], axis=1)


def _stacked(series: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in series])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of rows that can take part, one for each id.

    Rows go whose id or vector is null, whose vector is empty or zero, or has a null or non-finite
    component, or another length than most vectors have. Of rows that share an id the one with the
    least vector stays.
    """
    v = col(vector_col)
    sound = (v.isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0)
             & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = vectors.where(col(id_col).isNotNull() & F.coalesce(sound, F.lit(False))).groupBy(
        col(id_col).cast("long").alias("vec_id")).agg(F.min(v).alias("vector"))
    return rows


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            curves: int = CURVES, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` found nearest of each row for which ``is_query`` holds.

    ``is_query`` is a column of ``vec_id``. Nearness is the inner product of the original vectors in
    double precision; ties go to the smaller id. A query's own row is no candidate. Equal vectors are
    searched once and stand in the index once, with their ``k + 1`` smallest ids, which is all that a
    result can hold, so any number of copies costs no more. An empty table gives an empty one.

    ``recall`` sets the windows by :meth:`Curves.window`. Data without structure in many dimensions need wide
    ones: there the work grows with queries times vectors, as no order along curves keeps neighbours together.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors, id_col, vector_col), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("m"))
    sizes = sorted(sizes.collect(), key=lambda r: (-r["n"], r["d"]))
    dims, norm = (sizes[0]["d"], float(np.sqrt(sizes[0]["m"]))) if sizes else (1, 1.0)
    rows = rows.where(F.size("vector") == dims)
    numbered = rows.withColumn("nth", F.row_number().over(W.partitionBy("vector").orderBy("vec_id")))
    classes = stage(numbered.where(F.col("nth") <= k + 1).groupBy("vector").agg(
        F.min("vec_id").alias("cid"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    asked = stage(rows.where(is_query).join(classes.select("vector", "cid"), "vector").select("vec_id", "cid"), "queries")
    askers = stage(classes.join(asked.select("cid").distinct(), "cid", "left_semi").select("cid", "vector"), "askers")
    n, n_asked = classes.count(), askers.count()
    ranges = max(1, -(-n // RANGE_ROWS))
    share = min(1.0, SAMPLE / max(n, 1))
    sample = (classes.where(F.xxhash64("cid") / F.lit(2.0 ** 64) + 0.5 <= share).limit(2 * SAMPLE)
              .select("cid", "vector").toPandas())
    if not n or not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fitted, ids = _stacked(sample["vector"]), sample["cid"].to_numpy()
    index = Curves(dims, norm, curves).fit(fitted, ids, ranges)
    # a query lies in the middle of its own range on average, and meets at least the ranges beside it
    reach = max(1, int(np.ceil(index.window(fitted, ids, k, recall) * ranges / 2 - 0.5)))
    chunks = max(1, -(-n_asked * (2 * reach + 1) // (ranges * QUERY_ROWS)))

    def dealt(query: bool):
        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), 2048):
                    part = batch.iloc[at:at + 2048]
                    ids, values = part["cid"].to_numpy(), part["vector"].to_numpy()
                    found = index.ranges(_stacked(part["vector"]), ids, query)
                    around = range(-reach, reach + 1) if query else (0,)
                    for c in range(index.curves):
                        for move in around:
                            place = found[:, c] + move
                            for chunk in ((ids % chunks,) if query else range(chunks)):
                                keep = (place >= 0) & (place < ranges)
                                yield pd.DataFrame({"curve": c, "place": place[keep],
                                                    "chunk": (chunk[keep] if query else np.full(keep.sum(), chunk)),
                                                    "cid": ids[keep], "vector": values[keep]})
        return deal

    schema = f"curve int, place int, chunk int, cid long, vector {classes.schema['vector'].dataType.simpleString()}"
    parts = shuffle_partitions(spark) * 2
    keys = ["curve", "place", "chunk"]
    stored = classes.select("cid", "vector").repartition(parts).mapInPandas(dealt(False), schema)
    asking = askers.repartition(parts).mapInPandas(dealt(True), schema)

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"qid": [], "cids": [], "scores": []})
        ids = left["cid"].to_numpy()
        order = np.argsort(ids)  # equal scores: a stable sort then prefers small ids
        ids, values, out = ids[order], _stacked(left["vector"])[order], []
        for at in range(0, len(right), 512):
            part = right.iloc[at:at + 512]
            scores = _stacked(part["vector"]) @ values.T
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
            out.append(pd.DataFrame({"qid": part["cid"].to_numpy(), "cids": list(ids[best]),
                                     "scores": list(np.take_along_axis(scores, best, axis=1))}))
        return pd.concat(out)

    found = stored.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(
        compare, "qid long, cids array<long>, scores array<double>")
    merged = (found.select("qid", F.explode(F.arrays_zip("cids", "scores")).alias("f"))
              .select("qid", F.col("f.cids").alias("cid"), F.col("f.scores").alias("score")))
    # the own class holds the other copies of a query's vector, wherever the window lies
    own = askers.select(F.col("cid").alias("qid"), "cid", F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("score"))
    best = merged.unionByName(own).groupBy("qid", "cid").agg(F.max("score").alias("score"))
    ranked = W.partitionBy("qid").orderBy(F.desc("score"), "cid")
    best = best.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k + 1)
    members = best.join(classes.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    ranked = W.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    lists = (members.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k + 1).groupBy("qid")
             .agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found")))
    results = asked.join(stage(lists, "lists"), asked["cid"] == F.col("qid")).select(
        F.col("vec_id").alias("query_id"), F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("vec_id")), 1, k).alias("f"))
    return results.select("query_id", F.posexplode("f")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"),
        F.col("col.score").alias("score"))
