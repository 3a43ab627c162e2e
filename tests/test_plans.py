import json
import os

import pytest
from pyspark.sql import functions as F

from scoreloom.operators.audit import AuditError
from scoreloom.plans import act, evaluate, learn
from scoreloom.plans.config import LearnConfig

TYPES = {"id": "numeric", "label": "factor", "n1": "numeric", "n2": "numeric", "same": "numeric",
         "f1": "factor", "many": "factor", "gone": "factor"}


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(1500).select(
        "id", F.when(F.col("id") % 9 == 0, "yes").otherwise("no").alias("label"),
        F.when(F.col("id") % 13 != 0, F.col("id") * 7 % 50 + F.when(F.col("id") % 9 == 0, 20).otherwise(0)).alias("n1"),
        (F.col("id") * 31 % 97).cast("double").alias("n2"), F.lit(1.0).alias("same"),
        F.concat(F.lit("g"), (F.col("id") % 4).cast("string")).alias("f1"),
        F.concat(F.lit("m"), (F.col("id") % 300).cast("string")).alias("many"),
        F.when(F.col("id") < 5, "x").alias("gone")).cache()


def config(algorithm, hparams, **more):
    base = dict(types=TYPES, id_name="id", target_name="label", sampling_method="undersampling",
                unbalanced_cutoff=3, algorithm=algorithm, hparams=hparams, cv_k=1, calculate_iv=True,
                max_factor_levels=400)
    return LearnConfig(**{**base, **more})


def test_learn_act_test_round_trip(spark, table, tmp_path):
    folder = str(tmp_path)
    result = learn.learn(spark, config("RF", {"ntrees": [5], "max_depth": [4]}, reduce_levels_above=100),
                         table, folder + "/learn")
    assert result.prepared.removed == ["gone", "same"]
    assert result.prepared.level_codes is not None
    for name in ("learn_preprocess.json", "learn_configuration.json", "preprocess_report.txt",
                 "numeric_variables_summary.csv", "factor_variables_summary.csv", "iv_values.csv",
                 "woe_values.csv", "model_properties.json", "model_properties.txt", "model_metrics.json",
                 "model_metrics.txt", "variable-importance.csv", "gain-lift-table.csv",
                 "metrics-on-100-thresholds.csv"):
        assert os.path.exists(f"{folder}/learn/{name}/_SUCCESS"), name
    report = {(r.section, r.key): r.value for r in result.prepared.tables["preprocess_report.txt"].collect()}
    assert report["original", "sample amount"] == "1500"
    assert report["original label", "yes"] == "167"
    assert report["label after sampling", "no"] == "501"

    scored = act.act(spark, folder + "/learn", df=table.drop("label"), folder=folder + "/act")
    assert scored.predictions.columns == ["id", "predict", "p0", "p1"]
    assert scored.predictions.count() == 1500
    assert {r.predict for r in scored.predictions.select("predict").distinct().collect()} <= {"yes", "no"}
    assert scored.histogram.agg(F.sum("n")).first()[0] <= 1500
    back = spark.read.option("header", True).csv(folder + "/act/prediction.csv")
    assert back.count() == 1500

    by_act = evaluate.evaluate(spark, act_folder=folder + "/act", df=table, folder=folder + "/test")
    by_learn = evaluate.evaluate(spark, learn_folder=folder + "/learn", df=table)
    assert by_act["overall_metrics"].first() == by_learn["overall_metrics"].first()
    assert by_act["overall_metrics"].first().nobs == 1500
    assert os.path.exists(folder + "/test/test_metrics.json/_SUCCESS")


def test_naive_bayes_fill_travels_with_the_model(spark, table, tmp_path):
    folder = str(tmp_path)
    result = learn.learn(spark, config("NB", {"laplace": [1]}, fill={"f1": "g0"}, calculate_iv=False),
                         table, folder + "/learn")
    assert result.prepared.fill["f1"] == "g0" and set(result.prepared.fill) == {"n1", "n2", "f1", "many"}
    stored = json.loads(spark.read.text(folder + "/learn/learn_preprocess.json").first()[0])
    assert stored["fill"] == result.prepared.fill
    assert result.prepared.data.df.where("n1 is null").count() == 0
    by_set = {r.split: r for r in result.metrics["overall_metrics_by_set"].collect()}
    judged = result.metrics["overall_metrics"].first()
    assert "train" in by_set and len(by_set) == 2
    other = next(r for k, r in by_set.items() if k != "train")
    assert other.nobs == judged.nobs and other.auc == pytest.approx(judged.auc) and by_set["train"].nobs >= other.nobs


def test_kmeans_plan(spark, table, tmp_path):
    folder = str(tmp_path)
    learn.learn(spark, config("KM", {"k": [2], "max_iterations": [3]}), table, folder + "/learn")
    scored = act.act(spark, folder + "/learn", df=table, folder=folder + "/act")
    assert scored.histogram is None and scored.predictions.columns == ["id", "predict"]
    out = evaluate.evaluate(spark, learn_folder=folder + "/learn", df=table, folder=folder + "/test")
    assert out["quality"].first().betweenss > 0


def test_csv_and_catalog_inputs(spark, table, tmp_path):
    path = str(tmp_path / "data")
    table.select([F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c) for c in table.columns]) \
        .write.option("header", True).csv(path)
    cfg = config("LR", {"alpha": [0], "lambda": [0.1]}, path=path)
    by_csv = learn.import_data(spark, cfg)
    table.createOrReplaceTempView("plan_input")
    by_table = learn.import_data(spark, config("LR", None, table="plan_input"))
    assert by_csv.df.count() == by_table.df.count() == 1500
    assert by_csv.df.exceptAll(by_table.df).count() == 0


def test_bad_inputs(spark, table):
    with pytest.raises(AuditError, match="id_unique"):
        learn.import_data(spark, config("LR", None), table.unionByName(table))
    with pytest.raises(AuditError, match="label_not_null"):
        learn.import_data(spark, config("LR", None), table.withColumn("label", F.when(F.col("id") > 3, F.col("label"))))
    with pytest.raises(ValueError, match="unknown algorithm"):
        config("XGB", None)
    with pytest.raises(ValueError, match="target"):
        LearnConfig(types=TYPES, algorithm="LR")
    with pytest.raises(ValueError, match="unknown settings"):
        LearnConfig.from_dict({"algoritm": "LR"})
