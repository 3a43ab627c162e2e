"""Fit grid points on folds once each, and rank the points by exact AUC of what the folds did not see.

Every fold has a feature pipeline of its own, fitted on the rows of the other folds, so nothing of a
fold's rows is in the scores that judge it. The (point, fold) fits run on a thread pool; each writes its
held-out scores, and one grouped pass over all score rows ranks the points.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.functions.staging import new_path, stage
from scoreloom.operators.score import metrics_by

#: Fits that run at the same time.
PARALLEL_FITS = 8


def in_parallel(jobs: Sequence[Callable], width: int = PARALLEL_FITS) -> list:
    """The results of the jobs, in order, run on a pool that keeps the session's local properties."""
    keep = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, min(width, len(jobs)))) as pool:
        return list(pool.map(lambda run: run(), [keep(j) for j in jobs]))


@dataclass
class FoldFits:
    """Models of all (point, fold) pairs, their features by fold, and the scores of what each fold held out."""

    prepared: list
    models: dict[tuple[int, int], Model]
    scores: DataFrame          # point, fold, y, p1
    auc: list[float | None]    # by point, the mean over the folds
    whole: tuple | None = None  # features and shaped rows of all rows, for the last fit

    @property
    def best(self) -> int:
        known = [-np.inf if a is None else a for a in self.auc]
        return int(np.argmax(known))

    def evaluation(self, point: int) -> DataFrame:
        """``(y, p1, fold)`` of one point."""
        return self.scores.where(F.col("point") == point).select("y", "p1", "fold")


def with_probability(df: DataFrame) -> DataFrame:
    return df if "p1" in df.columns else df.withColumn("p1", vector_to_array("probability")[1])


def shape(prepare: Callable, rows: DataFrame, *others: DataFrame) -> tuple:
    """(what ``prepare`` makes of the rows, the staged features of the rows, of the other tables)."""
    made = prepare(rows)
    if made.features is None:
        return made, rows, *others
    # some algorithms stage the features of their own rows to prepare
    todo = others if made.shaped is not None else (rows, *others)
    done = in_parallel([lambda t=t: stage(made.transform(t), "features") for t in todo])
    return made, *([made.shaped] if made.shaped is not None else []), *done


def fit_folds(splits: Sequence[tuple[DataFrame, DataFrame]], prepare: Callable, points: Sequence[dict],
              label: str, whole: DataFrame | None = None) -> FoldFits:
    """Fit every point on every split's first table and score its second, each pair once.

    ``prepare`` fits the features of a table of rows and returns what transforms rows and fits points.
    A split's features are staged once for all points, those of ``whole`` at the same time. Points whose
    folds have one class only have no AUC.
    """
    jobs = [lambda a=a, b=b: shape(prepare, a, b) for a, b in splits]
    if whole is not None:
        jobs.append(lambda: shape(prepare, whole))
    splits = in_parallel(jobs)
    last = splits.pop() if whole is not None else None
    base = new_path(splits[0][1].sparkSession, "scores")

    def pair(fold: int, fits) -> tuple[int, int, Model]:
        point, model = next(fits)
        held = with_probability(model.transform(splits[fold][2]))
        held.select(column(label).cast("int").alias("y"), F.col("p1")).write.parquet(f"{base}/point={point}/fold={fold}")
        return point, fold, model

    jobs = []
    for k, (made, rows, _) in enumerate(splits):
        fits = made.fits(rows, points)  # shared by the split's jobs; each draws one point
        jobs += [lambda k=k, fits=fits: pair(k, fits) for _ in points]
    models = {(point, fold): model for point, fold, model in in_parallel(jobs)}
    spark = splits[0][1].sparkSession
    scores = spark.read.option("basePath", base).schema("y int, p1 double, point int, fold int").parquet(base)
    auc: list[float | None] = [None] * len(points)
    if len(points) > 1:
        means = metrics_by(scores, ["point", "fold"]).groupBy("point").agg(F.avg("auc").alias("auc"))
        for r in means.collect():
            auc[r["point"]] = r["auc"]
    return FoldFits([made for made, _, _ in splits], models, scores, auc, last)
