"""Test: replay the learned preparation on labelled rows and report the metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.functions.staging import stage
from scoreloom.operators.describe import fitted_parameters
from scoreloom.operators.score import classification_report
from scoreloom.operators.training import load_model
from scoreloom.plans import replay as rp
from scoreloom.sources import artifacts


def evaluate(spark: SparkSession, *, learn_folder: str | None = None, act_folder: str | None = None,
             df: DataFrame | None = None, table: str | None = None, path: str | None = None,
             folder: str | None = None) -> dict[str, DataFrame]:
    """The metric tables of a learned model; the learn folder wins when both are named."""
    if learn_folder:
        replay = rp.from_learn_folder(spark, learn_folder)
    elif act_folder:
        replay = rp.from_act_folder(spark, act_folder)
    else:
        raise ValueError("name a learn or an act folder")
    supervised = replay.algorithm != "KM"
    rows = rp.prepare(spark, rp.import_data(spark, replay, df=df, table=table, path=path,
                                            need_target=supervised), replay)
    model = load_model(spark, replay.model_path)
    if supervised:
        y = (column(replay.target_name) == F.lit(model.levels[1])).cast("int")
        scored = stage(model.score(rows, "__p").select(y.alias("y"), F.col("__p").alias("p1")), "scored")
        out = classification_report(scored, parameters=fitted_parameters(model))
    else:
        totals, per = model.quality(rows)
        out = {"quality": totals, "clusters": per}
    if folder:
        if supervised:
            artifacts.write_csv(out["gains_lift"], folder.rstrip("/") + "/gains-lift-table.csv")
            artifacts.write_csv(out["threshold_metrics"],
                                folder.rstrip("/") + "/metrics-on-100-thresholds.csv")
        artifacts.write_report_set(out, folder, "test_metrics")
    return out
