"""Learn: import, audit, profile, clean, rebalance, fill, weigh, train, save.

The cleaned rows are staged once; information value, training and reports read
that table. Profiles, report rows and thresholds are small results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.functions.staging import stage
from scoreloom.operators import describe, score, training, woe
from scoreloom.operators.audit import audit_id, audit_label, audit_volume, require
from scoreloom.operators.clean import (
    as_categories, drop_sparse_rows, droppable_variables, fill_missing, fill_values, learned_fill)
from scoreloom.operators.profile import (
    factor_profile, label_counts, level_counts, numeric_profile, profile_input)
from scoreloom.operators.sample import under_sample
from scoreloom.plans.config import LearnConfig
from scoreloom.roles import Dataset
from scoreloom.sources import artifacts, delimited, tables


@dataclass
class Prepared:
    """The cleaned dataset and everything learned about it."""

    data: Dataset
    types: dict[str, str]
    fill: dict[str, object]
    removed: list[str]
    tables: dict[str, DataFrame]
    level_codes: DataFrame | None = None


@dataclass
class LearnResult:
    prepared: Prepared
    model: training.TrainedModel | training.StackedModel | training.ClusterModel
    properties: dict[str, DataFrame]
    metrics: dict[str, DataFrame]


def import_data(spark: SparkSession, config: LearnConfig, df: DataFrame | None = None) -> Dataset:
    """Read by the dictionary and audit id, label and volume."""
    types = config.types
    if types is None and config.dictionary_path:
        types = delimited.read_dictionary(spark, config.dictionary_path, config.numeric_aliases,
                                          config.factor_aliases)
    if df is None and config.table:
        df = tables.read_table(spark, config.table)
    if df is not None:
        if types is None:
            raise ValueError("a table needs declared types")
        typed = tables.as_declared(df, types, config.id_name)
    elif types is None:
        typed, types = delimited.read_inferred(spark, config.path, config.separator,
                                               missing=config.missing, id_name=config.id_name)
    else:
        typed = delimited.read_declared(spark, config.path, types, config.separator,
                                        missing=config.missing, id_name=config.id_name)
    audits = [audit_volume(typed, config.id_name, config.target_name, min_rows=1)]
    if config.id_name:
        audits.append(audit_id(typed, config.id_name))
    if config.target_name:
        audits.append(audit_label(typed, config.target_name))
    require(*audits)
    return Dataset(as_categories(typed, config.id_name, config.target_name), dict(types),
                   config.id_name, config.target_name)


def row_keys(data: Dataset) -> list[str]:
    """Columns that identify a row for hashing: the id, or all of them."""
    return [data.id] if data.id else list(data.types)


def _section(name: str, key, value, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias("section"), key.cast("string").alias("key"),
                     value.cast("string").alias("value"))


def _facts(spark: SparkSession, name: str, facts: dict[str, object]) -> DataFrame:
    return spark.createDataFrame([(name, k, str(v)) for k, v in facts.items()],
                                 "section string, key string, value string")


def prepare(spark: SparkSession, data: Dataset, config: LearnConfig) -> Prepared:
    """Profile, drop, rebalance, fill and weigh; nothing is collected but small results."""
    original_types = dict(data.types)
    keys = row_keys(data)
    target = config.target_name
    n_rows = data.df.count()
    report = [_facts(spark, "original", {
        "id name": data.id, "target name": target, "sample amount": n_rows,
        "variable amount": len(data.df.columns)})]
    if target:
        counts = label_counts(data.df, target)
        report.append(_section("original label", F.col("label"), F.col("n"), counts))

    sampled = profile_input(data.df, config.profile_sampling, keys, config.seed)
    sample_rows = n_rows
    if sampled is not data.df:
        sampled = stage(sampled, "profiled")
        sample_rows = sampled.count()
    numeric = stage(numeric_profile(sampled, data.numeric), "numeric") if data.numeric else None
    factor = levels = None
    if data.factors:
        levels = stage(level_counts(sampled, data.factors), "levels")
        factor = stage(factor_profile(sampled, data.factors, counts=levels), "factor")

    if data.variables:
        kept_rows = drop_sparse_rows(data.df, data.variables, config.max_sample_missing)
        dropped = droppable_variables(numeric, factor, sample_rows, config.max_factor_levels,
                                      config.max_variable_missing)
        reasons: dict[str, set[str]] = {}
        for r in dropped.collect():  # at most a few rows per column
            reasons.setdefault(r["variable"], set()).add(r["reason"])
        removed = sorted(reasons)
        data = data.with_df(kept_rows).without(removed)
        report.append(_facts(spark, "removed variable",
                             {v: ", ".join(sorted(reasons[v])) for v in removed} or {"none": ""}))
    else:
        removed = []
    cleaned_rows = data.df.count()
    report.append(_facts(spark, "after deleting", {
        "sample amount": cleaned_rows, "variable amount": len(data.df.columns)}))

    if target and config.sampling_method == "undersampling":
        data = data.with_df(under_sample(data.df, target, config.unbalanced_cutoff, keys, config.seed))

    fill = dict(config.fill)
    if config.algorithm == "NB":
        left = set(data.variables)
        learned = learned_fill(
            numeric.where(F.col("variable").isin(*data.numeric)) if data.numeric else None,
            factor.where(F.col("variable").isin(*data.factors)) if data.factors else None)
        fill = {c: v for c, v in fill_values(learned, config.fill).items() if c in left}
    data = data.with_df(stage(fill_missing(data.df, fill), "cleaned"))
    out: dict[str, DataFrame] = {}
    if target:
        report.append(_section("label after sampling", F.col("label"), F.col("n"),
                               label_counts(data.df, target)))

    codes = None
    if config.profile:
        if numeric is not None:
            out["numeric_variables_summary.csv"] = numeric
        if factor is not None:
            out["factor_variables_summary.csv"] = factor
            out["factor_levels.csv"] = levels
    if target and config.calculate_iv and data.variables:
        labelled = woe.label_to_binary(data.df, target)
        iv, merged, merged_levels = woe.iv_and_levels(labelled, "y", data.numeric, data.factors)
        out["iv_values.csv"] = iv
        out["woe_values.csv"] = woe.woe_values(merged)
        out["woe_levels.csv"] = merged_levels
    if target and config.reduce_levels_above is not None and data.factors:
        numbers = {r["variable"]: r["level_num"] for r in factor.select("variable", "level_num").collect()}
        labelled = woe.label_to_binary(data.df, target, name="__y01")
        reduced, codes = woe.reduce_levels(labelled, "__y01", data.factors, numbers,
                                           config.reduce_levels_above)
        data = data.with_df(reduced.drop("__y01"))

    text = report[0]
    for part in report[1:]:
        text = text.unionByName(part)
    out["preprocess_report.txt"] = text
    return Prepared(data, original_types, fill, removed, out, codes)


def label_levels(df: DataFrame, target: str) -> tuple[str, str]:
    """The two label levels in order; the second is the one models predict."""
    found = sorted(r[0] for r in df.select(column(target)).distinct().limit(3).collect())
    if len(found) != 2:
        raise ValueError(f"a classifier needs two label levels, {target} has {found}")
    return found[0], found[1]


def train(spark: SparkSession, prepared: Prepared, config: LearnConfig):
    """Fit, describe and judge. Returns (model, properties, metrics)."""
    data = prepared.data
    keys = row_keys(data)
    if config.algorithm == "KM":
        result = training.train_kmeans(data.df, data.numeric, data.factors, keys, config.hparams,
                                       config.cv_k)
        properties = describe.properties_report(spark, result.model, data.df)
        metrics = {"quality_by_set": result.quality, "clusters_by_set": result.clusters}
        if result.holdout is not None:
            held = F.col("set") == "valid"
            metrics |= {"quality_valid": result.quality.where(held).drop("set", "size"),
                        "clusters_valid": result.clusters.where(held).drop("set", "fold")}
        return result.model, properties, metrics

    levels = label_levels(data.df, config.target_name)
    y = "__y"
    df = data.df.withColumn(y, (column(config.target_name) == F.lit(levels[1])).cast("int"))
    if config.algorithm == "Stacking":
        result = training.train_stacking(df, y, data.numeric, data.factors, config.hparams, keys,
                                         config.cv_k, levels)
    else:
        result = training.train_classifier(df, y, data.numeric, data.factors, config.algorithm, keys,
                                           config.hparams, config.cv_k, levels)
    evaluation = stage(result.evaluation, "evaluation")
    metrics = score.classification_report(evaluation, parameters=describe.fitted_parameters(result.model))
    metrics["overall_metrics_by_set"] = metrics_by_set(result, y, evaluation)
    best_f1 = metrics["best_thresholds"].where(F.col("metric") == "f1").first()
    result.model.threshold = float(best_f1["threshold"])
    folds = result.folds if result.kind == "xval" else 0
    properties = describe.properties_report(spark, result.model, result.train, evaluation, folds)
    return result.model, properties, metrics


def metrics_by_set(result: training.TrainingResult, y: str, evaluation: DataFrame) -> DataFrame:
    """The overall metrics of the training rows and of the rows that judge the model, from one pass over both.

    ``split`` is ``train`` and ``xval`` or ``valid``; the training rows are scored by the final model.
    """
    seen = result.model.score(result.train).select(column(y).cast("int").alias("y"), "p1", F.lit("train").alias("split"))
    judged = evaluation.select(F.col("y").cast("int").alias("y"), "p1", F.lit(result.kind).alias("split"))
    return score.metrics_by(seen.unionByName(judged), ["split"])


# Names of the artefact files.
PROPERTY_FILES = {"cross_validation_summary": "cross-validation-summary.csv",
                  "variable_importance": "variable-importance.csv",
                  "variable_coefficients": "variable-coefficients.csv"}
METRIC_FILES = {"gains_lift": "gain-lift-table.csv",
                "threshold_metrics": "metrics-on-100-thresholds.csv"}


def save(spark: SparkSession, result: LearnResult, config: LearnConfig, folder: str) -> None:
    """Write the preprocessing and training artefacts and the model."""
    folder = folder.rstrip("/")
    prepared = result.prepared
    for name, df in prepared.tables.items():
        write = artifacts.write_report if name.endswith(".txt") else artifacts.write_csv
        write(df, f"{folder}/{name}")
    result.model.save(folder + "/model")
    if prepared.level_codes is not None:
        prepared.level_codes.write.mode("overwrite").parquet(folder + "/level_codes")
    training.write_json(spark, folder + "/learn_preprocess.json", {
        "types": prepared.types, "removed": prepared.removed, "fill": prepared.fill,
        "id_name": config.id_name, "target_name": config.target_name,
        "level_codes": prepared.level_codes is not None})
    training.write_json(spark, folder + "/learn_configuration.json",
                        config.as_dict() | {"model_path": folder + "/model"})
    artifacts.write_report_set(result.properties, folder, "model_properties")
    for key, name in PROPERTY_FILES.items():
        if key in result.properties:
            artifacts.write_csv(result.properties[key], f"{folder}/{name}")
    if result.metrics:
        artifacts.write_report_set(result.metrics, folder, "model_metrics")
    for key, name in METRIC_FILES.items():
        if key in result.metrics:
            artifacts.write_csv(result.metrics[key], f"{folder}/{name}")


def learn(spark: SparkSession, config: LearnConfig, df: DataFrame | None = None,
          folder: str | None = None) -> LearnResult:
    """The whole plan; artefacts are written when a folder is named."""
    prepared = prepare(spark, import_data(spark, config, df), config)
    model, properties, metrics = train(spark, prepared, config)
    result = LearnResult(prepared, model, properties, metrics)
    if folder:
        save(spark, result, config, folder)
    return result
