"""Act: replay the learned preparation on new rows, predict, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from scoreloom.functions.staging import stage
from scoreloom.operators.score import score_histogram
from scoreloom.operators.training import load_model, predict, write_json
from scoreloom.plans import replay as rp
from scoreloom.sources import artifacts


@dataclass
class ActResult:
    predictions: DataFrame
    histogram: DataFrame | None


def act(spark: SparkSession, learn_folder: str, *, df: DataFrame | None = None,
        table: str | None = None, path: str | None = None, folder: str | None = None) -> ActResult:
    """Predictions with the id column, and the score histogram of a classifier.

    Predictions are written by the executors; the model is applied once.
    """
    replay = rp.from_learn_folder(spark, learn_folder)
    rows = rp.prepare(spark, rp.import_data(spark, replay, df=df, table=table, path=path), replay)
    model = load_model(spark, replay.model_path)
    predictions = stage(predict(model, rows, replay.id_name), "predictions")
    histogram = score_histogram(predictions) if "p1" in predictions.columns else None
    if folder:
        folder = folder.rstrip("/")
        artifacts.write_csv(predictions, folder + "/prediction.csv")
        write_json(spark, folder + "/act_config.json", replay.as_dict())
        if histogram is not None:
            artifacts.write_json_rows(histogram, folder + "/prediction_bins.json")
    return ActResult(predictions, histogram)
