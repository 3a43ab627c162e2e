"""Descriptions of trained models as small DataFrames."""

from __future__ import annotations

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.score import metrics_by
from scoreloom.operators.training import (
    FEATURES, ClusterModel, StackedModel, TrainedModel, feature_names)


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    # model parameters only: their number does not depend on the data
    return spark.createDataFrame(rows, schema)


def actual_parameters(spark: SparkSession, model) -> DataFrame:
    """``(param, value)``: every final parameter value."""
    if isinstance(model, StackedModel):
        values = {f"base{i}.{k}": v for i, b in enumerate(model.bases)
                  for k, v in {"algorithm": b.algorithm, **b.params}.items()}
        values |= {"combiner." + p.name: v for p, v in model.combiner.extractParamMap().items()}
    else:
        values = {p.name: v for p, v in model.predictor.extractParamMap().items()}
        values |= model.params
    return _rows(spark, sorted((k, str(v)) for k, v in values.items()), "param string, value string")


def model_summary(spark: SparkSession, model: TrainedModel | ClusterModel) -> DataFrame:
    """``(property, value)``."""
    m = model.predictor
    out: dict[str, object] = {"algorithm": model.algorithm}
    if model.algorithm in ("GBM", "RF"):
        depth = [t.depth for t in m.trees]
        nodes = [t.numNodes for t in m.trees]
        out |= {"number_of_trees": len(depth), "number_of_features": m.numFeatures,
                "min_depth": min(depth), "max_depth": max(depth), "mean_depth": float(np.mean(depth)),
                "min_nodes": min(nodes), "max_nodes": max(nodes), "mean_nodes": float(np.mean(nodes))}
    elif model.algorithm == "LR":
        out |= {"number_of_features": m.numFeatures, "regularization": m.getRegParam(),
                "elastic_net": m.getElasticNetParam(),
                "nonzero_coefficients": int(np.count_nonzero(m.coefficients.toArray()))}
        if m.hasSummary:
            out["number_of_iterations"] = m.summary.totalIterations
    elif model.algorithm == "DL":
        out |= {"layers": m.getLayers(), "number_of_weights": len(m.weights)}
    elif model.algorithm == "NB":
        out |= {"number_of_numeric": len(model.numeric), "number_of_factors": len(model.factors),
                "number_of_level_rows": m.tables.levels.count()}
    elif model.algorithm == "KM":
        out |= {"number_of_clusters": len(m.clusterCenters())}
        if model.iterations is not None:
            out["number_of_iterations"] = model.iterations
    return _rows(spark, [(k, str(v)) for k, v in out.items()], "property string, value string")


def cross_validation_summary(out_of_fold: DataFrame, folds: int) -> DataFrame:
    """``(metric, mean, sd, fold_values)`` over the folds, all of them from one pass over the scores."""
    per = metrics_by(out_of_fold.where(F.col("fold").between(0, folds - 1)), ["fold"])
    metrics = ["mse", "rmse", "logloss", "r2", "auc", "gini"]
    long = per.unpivot(["fold"], metrics, "metric", "value")
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "value"))), lambda x: x["value"])
        .alias("fold_values"))


def _net_importance(layers: list[int], weights: np.ndarray) -> np.ndarray:
    """Share of each input in the absolute weights of the first two layers."""
    n, h, o = layers[:3]
    first = np.abs(weights[:n * h]).reshape(n, h)
    start = n * h + h
    second = np.abs(weights[start:start + h * o]).reshape(h, o)
    into = first / np.maximum(first.sum(axis=0, keepdims=True), 1e-300)
    onward = second / np.maximum(second.sum(axis=0, keepdims=True), 1e-300)
    return (into @ onward).sum(axis=1)


def variable_importance(model: TrainedModel, sample: DataFrame) -> DataFrame:
    """``(variable, raw, scaled, share)`` per feature of DL, GBM and RF models.

    ``sample`` is any table with the training columns; only its schema is used.
    """
    if model.algorithm not in ("DL", "GBM", "RF"):
        raise ValueError("importance exists for DL, GBM and RF")
    names = feature_names(model.features.transform(sample), model.numeric, model.factors)
    if model.algorithm == "DL":
        raw = _net_importance(list(model.predictor.getLayers()), model.predictor.weights.toArray())
    else:
        raw = model.predictor.featureImportances.toArray()
    top, total = max(raw.max(), 1e-300), max(raw.sum(), 1e-300)
    rows = [(n, float(v), float(v / top), float(v / total)) for n, v in zip(names, raw)]
    return _rows(sample.sparkSession, rows, "variable string, raw double, scaled double, share double")


def linear_coefficients(model: TrainedModel, train: DataFrame) -> DataFrame:
    """``(variable, coefficient, standardized)``, the intercept first."""
    if model.algorithm != "LR":
        raise ValueError("coefficients exist for LR")
    shaped = model.features.transform(train)
    names = feature_names(shaped, model.numeric, model.factors)
    sd = shaped.select(Summarizer.std(F.col(FEATURES)).alias("s")).first()["s"].toArray()
    coefficients = model.predictor.coefficients.toArray()
    rows = [("Intercept", float(model.predictor.intercept), None)]
    rows += [(n, float(b), float(b * s)) for n, b, s in zip(names, coefficients, sd)]
    return _rows(train.sparkSession, rows, "variable string, coefficient double, standardized double")


def fitted_parameters(model) -> int | None:
    """Number of fitted coefficients of a linear model, for AIC."""
    if getattr(model, "algorithm", None) != "LR":
        return None
    return int(np.count_nonzero(model.predictor.coefficients.toArray())) + 1


def cluster_centres(model: ClusterModel, sample: DataFrame) -> DataFrame:
    """``(cluster, feature, centre_std, centre)``: scaled and original centres."""
    names = feature_names(model.features.transform(sample), model.numeric, model.factors)
    scaler = model.features.stages[-1]
    scaled = bool(model.params.get("standardize", True))
    rows = []
    for k, c in enumerate(model.predictor.clusterCenters()):
        back = c * scaler.std.toArray() + scaler.mean.toArray() if scaled else c
        rows += [(k, n, float(s) if scaled else None, float(v)) for n, s, v in zip(names, c, back)]
    return _rows(sample.sparkSession, rows,
                 "cluster int, feature string, centre_std double, centre double")


def properties_report(spark: SparkSession, model, train: DataFrame,
                      out_of_fold: DataFrame | None = None, folds: int = 0) -> dict[str, DataFrame]:
    """The description tables that exist for the algorithm."""
    out = {"actual_parameters": actual_parameters(spark, model)}
    if model.algorithm != "Stacking":
        out["model_summary"] = model_summary(spark, model)
    if model.algorithm == "KM":
        totals, per = model.quality(train)
        return out | {"centres": cluster_centres(model, train), "quality": totals, "clusters": per}
    if out_of_fold is not None and folds >= 2:
        out["cross_validation_summary"] = cross_validation_summary(out_of_fold, folds)
    if model.algorithm in ("DL", "GBM", "RF"):
        out["variable_importance"] = variable_importance(model, train)
    if model.algorithm == "LR":
        out["variable_coefficients"] = linear_coefficients(model, train)
    return out
