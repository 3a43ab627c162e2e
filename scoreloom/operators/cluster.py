"""Assignment to fixed centres and cluster quality."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.functions.staging import stage
from scoreloom.operators.kmeans import blocks, nearest, part_table, square_distance


def _square_distance(columns: Sequence[str], centre: Sequence[float]) -> Column:
    out = F.lit(0.0)
    for c, m in zip(columns, centre):
        gap = column(c).cast("double") - F.lit(float(m))
        out = out + gap * gap
    return out


def assign(df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]],
           cluster: str = "cluster", distance: str = "sq_dist") -> DataFrame:
    """Add the nearest centre (lowest number on ties) and the squared distance to it.

    The centres are model parameters: constants of one projection, no join.
    """
    options = F.array(*[F.struct(_square_distance(columns, m).alias("d"), F.lit(i).alias("k"))
                        for i, m in enumerate(centres)])
    return (df.withColumn("__best", F.array_min(options))
            .withColumn(cluster, F.col("__best.k")).withColumn(distance, F.col("__best.d"))
            .drop("__best"))


def cluster_quality(assigned: DataFrame, columns: Sequence[str], cluster: str = "cluster",
                    distance: str = "sq_dist") -> tuple[DataFrame, DataFrame]:
    """(one-row totals, per-cluster rows).

    Totals: ``totss`` to the grand mean, ``tot_withinss``, ``betweenss``. Rows:
    ``cluster, size, withinss`` and the cluster mean of every column. The total
    sum of squares comes from count and variance, so one pass is enough.
    """
    per = assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), F.sum(distance).alias("withinss"),
        *[F.avg(column(c).cast("double")).alias("mean_" + c) for c in columns])
    spread = sum((F.var_pop(column(c).cast("double")) * F.count(column(c)) for c in columns), F.lit(0.0))
    totals = (assigned.agg(spread.alias("totss"), F.sum(distance).alias("tot_withinss"))
              .withColumn("betweenss", F.col("totss") - F.col("tot_withinss")))
    return totals, per


#: One judged model: the part of the rows it is judged on, the set and fold it is reported under, its number, its centres.
Judged = tuple[int, str, int, int, Sequence[Sequence[float]]]


_STATISTICS = "id int, cluster int, size bigint, withinss double, mean array<double>, spread array<double>"


def _statistics(models: Sequence[tuple[int, np.ndarray]]) -> Callable:
    """Rows of a task by judged model (its part, its centres) and cluster with ``size`` and ``withinss``, and by part
    (cluster null) with ``size``, ``mean`` and the sum of squares about it, ``spread``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = [np.zeros(len(c), np.int64) for _, c in models]
        within = [np.zeros(len(c)) for _, c in models]
        parts: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        judged = {p for p, _ in models}
        for part, rows in blocks(batches):
            if part not in judged:
                continue
            n, mean = len(rows), rows.mean(axis=0)
            spread = ((rows - mean) ** 2).sum(axis=0)
            if part in parts:
                m, other, before = parts[part]
                gap = mean - other
                n, mean, spread = n + m, other + gap * (n / (n + m)), before + spread + gap * gap * (n * m / (n + m))
            parts[part] = n, mean, spread
            for i, (at, centres) in enumerate(models):
                if at == part:
                    own = nearest(rows, centres)
                    sizes[i] += np.bincount(own, minlength=len(centres))
                    within[i] += np.bincount(own, square_distance(rows, centres, own), minlength=len(centres))
        out = [(i, k, int(n), float(w), None, None) for i in range(len(models))
               for k, (n, w) in enumerate(zip(sizes[i], within[i])) if n]
        out += [(p, None, n, None, mean.tolist(), spread.tolist()) for p, (n, mean, spread) in parts.items()]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             ["id", "cluster", "size", "withinss", "mean", "spread"])
    return run


def quality_by_set(rows: DataFrame, vector: str, part: str, models: Sequence[Judged]) -> tuple[DataFrame, DataFrame]:
    """Cluster quality of many models, each on the parts of the rows it names, from one pass over the rows.

    ``rows`` has a vector and the number of its part, or is packed. Returns totals ``(set, model, size, totss,
    tot_withinss, betweenss)`` and clusters ``(set, model, fold, cluster, size, withinss)``. A set's totals are
    the sums over its folds, with ``totss`` to the mean of each fold. A cluster that no row is nearest to has
    size 0; a fold without rows adds nothing.

    The centres go to the tasks with the function; each gives its sums, which are put together here.
    """
    spark = rows.sparkSession
    # proven bound: grid points x folds rows of k x slots numbers
    table = spark.createDataFrame(
        [(i, p, name, m, f, len(centres)) for i, (p, name, m, f, centres) in enumerate(models)],
        "judged int, at int, set string, model int, fold int, k int")
    keys = ["set", "model", "fold"]
    matrices = [(p, np.array(centres, np.float64)) for p, _, _, _, centres in models]
    # a few rows a task, read twice
    found = stage(part_table(rows, vector, part).mapInArrow(_statistics(matrices), _STATISTICS), "clusters")

    per = (found.where("cluster IS NOT NULL").select(F.col("id").alias("judged"), "cluster", "size", "withinss")
           .join(F.broadcast(table), "judged").groupBy(*keys, "cluster")
           .agg(F.sum("size").alias("size"), F.sum("withinss").alias("withinss")))
    slots = (found.where("cluster IS NULL").select(F.col("id").alias("at"), "size", "mean", "spread")
             .join(F.broadcast(table), "at")
             .select(*keys, "size", F.posexplode(F.arrays_zip("mean", "spread")).alias("slot", "m")))
    whole = W.partitionBy(*keys, "slot")
    grand = F.sum(F.col("size") * F.col("m.mean")).over(whole) / F.sum("size").over(whole)
    gap = F.col("m.mean") - grand
    spread = slots.select("set", "model", (F.col("m.spread") + F.col("size") * gap * gap).alias("ss"))
    within = per.groupBy("set", "model").agg(F.sum("size").alias("size"), F.sum("withinss").alias("tot_withinss"))
    totals = (within.join(spread.groupBy("set", "model").agg(F.sum("ss").alias("totss")), ["set", "model"])
              .select("set", "model", "size", "totss", "tot_withinss",
                      (F.col("totss") - F.col("tot_withinss")).alias("betweenss")))
    every = table.select(*keys, F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("cluster")).distinct()
    clusters = (every.join(per, [*keys, "cluster"], "left")
                .fillna({"size": 0, "withinss": 0.0}))
    return totals, clusters
