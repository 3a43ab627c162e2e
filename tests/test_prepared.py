"""Features that logistic regression prepares once, and folds that are hashed once."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scoreloom.functions.staging import stage
from scoreloom.operators import folds, training
from scoreloom.operators.sample import modulo_fold


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(600).select(
        "id", (F.col("id") % 2).cast("int").alias("y"), F.when(F.col("id") % 7 > 0, F.rand(3)).alias("x"),
        F.lit(1.0).alias("same"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("g")).cache()


def plain(df):
    return sorted((r.y, r.v) for r in df.select("y", vector_to_array(training.FEATURES).alias("v")).collect())


def test_logistic_features_are_staged_once(spark, table):
    made = training._prepare("LR", table, "y", ["x", "same"], ["g"])
    assert plain(made.shaped) == plain(made.transform(table))
    own, other = folds.shape(lambda rows: made, table, table.where("id < 50"))[1:]
    assert own is made.shaped and other.count() == 50
    assert all("scoreloom-features" in f for f in made.shaped.inputFiles()) and made.shaped.inputFiles()
    assert made.width == len(plain(made.shaped)[0][1])


def test_stored_folds_are_those_of_the_keys(spark, table):
    stored = stage(table.withColumn(training.FOLD, modulo_fold(["id"], 3)))
    for (a, b), (c, d) in zip(training.fold_splits(stored, ["id"], 3), training.fold_splits(table, ["id"], 3)):
        assert sorted(b.select("id").collect()) == sorted(d.select("id").collect())
        assert a.count() == c.count() == 600 - b.count()
        assert "md5" not in b._jdf.queryExecution().optimizedPlan().toString()
    result = training.train_classifier(table, "y", ["x"], ["g"], "LR", ["id"], {"alpha": [0], "lambda": [0.1]}, 3)
    assert result.train.columns == ["x", "g", "y", "id"] and result.evaluation.count() == 600
