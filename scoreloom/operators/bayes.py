"""Naive Bayes on mixed columns as two aggregations and a chain of lookups.

Factor likelihood ``(n_level_label + laplace) / (n_label + laplace * levels)``,
numeric likelihood Gaussian with the label's mean and sample deviation (replaced
by ``min_sdev`` when at or below ``eps_sdev``), prior ``n_label / n``. A level that was
seen, but never with one of the labels, has likelihood ``min_prob`` there when nothing smooths
it. A missing cell and a level never seen in training contribute nothing.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.columns import column, sample_deviation
from scoreloom.functions.reshape import stack_rows
from scoreloom.functions.staging import stage
from scoreloom.operators.woe import bin_counts


@dataclass(frozen=True)
class BayesTables:
    """The aggregates; smoothing parameters are applied when scoring."""

    levels: DataFrame    # variable, level, n_1, n_0
    moments: DataFrame   # variable, mean_1, sd_1, mean_0, sd_0
    labels: DataFrame    # n_1, n_0 (one row)
    numeric: tuple[str, ...]
    factors: tuple[str, ...]


def bayes_tables(df: DataFrame, y: str, numeric: Sequence[str], factors: Sequence[str]) -> BayesTables:
    """Two passes: level counts per label, and moments per label in one aggregate."""
    spark = df.sparkSession
    df = df.where(column(y).isNotNull())
    if factors:
        levels = bin_counts(df, y, factors).where(F.col("bin").isNotNull()).select(
            "variable", F.col("bin").alias("level"), F.col("pos").alias("n_1"), F.col("neg").alias("n_0"))
    else:
        levels = spark.createDataFrame([], "variable string, level string, n_1 bigint, n_0 bigint")
    measures = [F.count_if(column(y) == 1).alias("n_1"), F.count_if(column(y) == 0).alias("n_0")]
    for i, c in enumerate(numeric):
        for k in (0, 1):
            x = F.when(column(y) == k, column(c).cast("double"))
            measures += [F.avg(x).alias(f"m{i}_{k}"), sample_deviation(x).alias(f"s{i}_{k}")]
    wide = stage(df.agg(*measures), "moments")
    if numeric:
        moments = stack_rows(wide, [
            {"variable": F.lit(c), "mean_1": F.col(f"m{i}_1"), "sd_1": F.col(f"s{i}_1"),
             "mean_0": F.col(f"m{i}_0"), "sd_0": F.col(f"s{i}_0")} for i, c in enumerate(numeric)])
    else:
        moments = spark.createDataFrame(
            [], "variable string, mean_1 double, sd_1 double, mean_0 double, sd_0 double")
    return BayesTables(stage(levels, "levels"), moments, wide.select("n_1", "n_0"),
                       tuple(numeric), tuple(factors))


def _gaussian(x: Column, mean: float | None, sd: float | None, min_sdev: float, eps_sdev: float) -> Column:
    if mean is None:
        return F.lit(0.0)
    width = min_sdev if sd is None or sd <= eps_sdev else sd
    z = (x - F.lit(mean)) / F.lit(width)
    return F.lit(-math.log(width)) - z * z / F.lit(2.0)


def bayes_score(df: DataFrame, model: BayesTables, laplace: float = 0.0, min_sdev: float = 0.001,
                eps_sdev: float = 0.0, min_prob: float = 0.001) -> DataFrame:
    """Add ``p1``. Each factor is one lookup join on its level table.

    The level tables are staged, so the planner broadcasts each one only when
    its true size is under the broadcast threshold and shuffles otherwise.
    """
    names = df.columns
    label = model.labels.first()
    if not label["n_1"] or not label["n_0"]:
        raise ValueError("naive Bayes needs rows of both labels")
    # one row per numeric column, one per factor
    moments = {r["variable"]: r for r in model.moments.collect()}
    sizes = {r["variable"]: r["n"] for r in model.levels.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    odds = F.lit(math.log(label["n_1"] / label["n_0"]))
    for c in model.numeric:
        m = moments[c]
        x = column(c).cast("double")
        odds = odds + F.coalesce(
            _gaussian(x, m["mean_1"], m["sd_1"], min_sdev, eps_sdev)
            - _gaussian(x, m["mean_0"], m["sd_0"], min_sdev, eps_sdev), F.lit(0.0))
    for i, c in enumerate(model.factors):
        levels = sizes.get(c, 0)
        shares = [(F.col(n) + laplace) / F.lit(label[n] + laplace * levels) for n in ("n_1", "n_0")]
        one, zero = (F.ln(F.when(s > 0, s).otherwise(F.lit(min_prob))) for s in shares)
        gain = one - zero
        table = model.levels.where(F.col("variable") == c).select(
            F.col("level").alias("__lv%d" % i), gain.alias("__ll%d" % i))
        df = df.join(table, column(c).cast("string") == F.col("__lv%d" % i), "left")
        odds = odds + F.coalesce(F.col("__ll%d" % i), F.lit(0.0))
    return df.select(*[column(n) for n in names], (1 / (1 + F.exp(-odds))).alias("p1"))


def save_bayes(model: BayesTables, path: str, **smoothing: float) -> None:
    model.levels.write.mode("overwrite").parquet(path + "/levels")
    model.moments.write.mode("overwrite").parquet(path + "/moments")
    model.labels.write.mode("overwrite").parquet(path + "/labels")
    shape = json.dumps({"numeric": model.numeric, "factors": model.factors, "smoothing": smoothing})
    spark = model.labels.sparkSession
    spark.createDataFrame([(shape,)], "value string").write.mode("overwrite").text(path + "/shape")


def load_bayes(spark: SparkSession, path: str) -> tuple[BayesTables, dict[str, float]]:
    shape = json.loads(spark.read.text(path + "/shape").first()[0])
    tables = BayesTables(spark.read.parquet(path + "/levels"), spark.read.parquet(path + "/moments"),
                         spark.read.parquet(path + "/labels"), tuple(shape["numeric"]),
                         tuple(shape["factors"]))
    return tables, shape["smoothing"]
