import math

import pytest
from pyspark.sql import functions as F

from helpers import rows
from scoreloom.operators import bayes, cluster, describe, grids, training
from scoreloom.operators.score import overall_metrics, score_counts, score_steps

NUMERIC, FACTORS = ["a", "b"], ["f"]


@pytest.fixture(scope="module")
def data(spark):
    x = spark.range(1200)
    return x.select(
        "id", F.when(F.col("id") % 17 != 0, (F.col("id") * 37 % 101).cast("double")).alias("a"),
        (F.col("id") * 53 % 89).cast("double").alias("b"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("l"), (F.col("id") % 5).cast("string"))).alias("f"),
        ((F.col("id") * 37 % 101 > 50) | (F.col("id") % 5 == 0)).cast("int").alias("y")).cache()


SMALL = {"LR": {"alpha": [0], "lambda": [0.0, 0.01]}, "GBM": {"ntrees": [3], "max_depth": [3]},
         "RF": {"ntrees": [5], "max_depth": [4]}, "NB": {"laplace": [0.1, 1]}, "DL": {"hidden": [[4]]}}


@pytest.mark.parametrize("algorithm,cv_k", [("LR", 3), ("LR", 1), ("GBM", 1), ("RF", 1), ("NB", 2), ("DL", 1)])
def test_train_save_load_predict(spark, data, tmp_path, algorithm, cv_k):
    result = training.train_classifier(data, "y", NUMERIC, FACTORS, algorithm, ["id"], SMALL[algorithm], cv_k)
    assert result.kind == ("xval" if cv_k > 1 else "valid")
    if cv_k > 1:
        assert result.evaluation.count() == data.count()
    auc = overall_metrics(score_steps(score_counts(result.evaluation))).first().auc
    assert auc > 0.7
    result.model.save(str(tmp_path / "m"))
    back = training.load_model(spark, str(tmp_path / "m"))
    a = rows(training.predict(result.model, data, "id").select("id", F.round("p1", 9).alias("p")))
    b = rows(training.predict(back, data, "id").select("id", F.round("p1", 9).alias("p")))
    assert a == b and len(a) == 1200
    # an unseen level and a missing cell are scored
    odd = spark.createDataFrame([(1, None, 3.0, "never")], "id long, a double, b double, f string")
    assert 0 <= training.predict(back, odd, "id").first().p1 <= 1
    tables = describe.properties_report(spark, back, result.train, result.evaluation, cv_k if cv_k > 1 else 0)
    if algorithm in ("GBM", "RF", "DL"):
        shares = tables["variable_importance"].collect()
        assert sum(r.share for r in shares) == pytest.approx(1.0)
        assert any(r.variable == "a" for r in shares)
    if algorithm == "LR":
        assert "Intercept" in {r.variable for r in tables["variable_coefficients"].collect()}


def test_no_pair_is_fitted_twice(spark, data, monkeypatch):
    """Points times folds, and the winner once on all rows; the score that ranks a point is the exact AUC."""
    from pyspark.ml.classification import LogisticRegression

    fits, plain = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: fits.append(1) or plain(self, df))
    grid = {"alpha": [0], "lambda": [0.0, 0.05, 5.0]}
    result = training.train_classifier(data, "y", NUMERIC, FACTORS, "LR", ["id"], grid, 3)
    assert len(fits) == 3 * 3 + 1
    best = max(result.model.trials, key=lambda t: t["auc"])
    assert {k: best[k] for k in grid} == result.model.params
    per_fold = []
    for k in range(3):
        held = [(r.p1, r.y) for r in result.evaluation.where(F.col("fold") == k).collect()]
        pos, neg = [p for p, y in held if y], [p for p, y in held if not y]
        per_fold.append(sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg))
    assert best["auc"] == pytest.approx(sum(per_fold) / 3)
    assert result.evaluation.count() == data.count()


def test_stacking(spark, data, tmp_path):
    result = training.train_stacking(data, "y", NUMERIC, FACTORS, {k: SMALL[k] for k in ("LR", "RF", "NB")},
                                     ["id"], 2)
    assert min(result.model.combiner.coefficients.toArray()) >= 0
    result.model.save(str(tmp_path / "m"))
    back = training.load_model(spark, str(tmp_path / "m"))
    assert rows(training.predict(back, data, "id").select("id", F.round("p1", 9))) == \
        rows(training.predict(result.model, data, "id").select("id", F.round("p1", 9)))
    assert describe.actual_parameters(spark, back).count() > 3


def test_kmeans(spark, data, tmp_path):
    result = training.train_kmeans(data, NUMERIC, FACTORS, ["id"],
                                   {"k": [2, 4], "max_iterations": [5], "standardize": [True]}, 2)
    totals, per = result.model.quality(data)
    t = totals.first()
    assert t.betweenss == pytest.approx(t.totss - t.tot_withinss)
    assert sum(r["size"] for r in per.collect()) == 1200
    assert sum(r.withinss for r in per.collect()) == pytest.approx(t.tot_withinss)
    result.model.save(str(tmp_path / "m"))
    back = training.load_model(spark, str(tmp_path / "m"))
    assert rows(training.predict(back, data, "id")) == rows(training.predict(result.model, data, "id"))
    assert describe.cluster_centres(back, data).where("centre_std is null").count() == 0


def test_kmeans_reports_all_sets(spark, data):
    grid = {"k": [2, 4], "max_iterations": [5], "standardize": [True, False]}
    for folds, held in ((3, "xval"), (1, "valid")):
        result = training.train_kmeans(data, NUMERIC, FACTORS, ["id"], grid, folds)
        sets = {r["set"]: r for r in result.quality.collect()}
        assert set(sets) == {"train", held}
        assert sets["train"]["size"] == result.train.count()
        assert sets[held]["size"] == (1200 if folds == 3 else result.holdout.count())
        whole = result.model.quality(result.train)[0].first()
        assert sets["train"].totss == pytest.approx(whole.totss) and sets["train"].tot_withinss == pytest.approx(whole.tot_withinss)
        if folds == 1:
            other = result.model.quality(result.holdout)[0].first()
            assert sets[held].betweenss == pytest.approx(other.betweenss)
        within = {}
        for r in result.clusters.collect():
            within[r["set"]] = within.get(r["set"], 0) + r.withinss
        assert within == pytest.approx({k: r.tot_withinss for k, r in sets.items()})
        best = max(t["betweenss"] for t in result.model.trials)
        assert best == pytest.approx(sets[held].betweenss / (3 if folds == 3 else 1))


def test_quality_by_set_with_empty_clusters_and_folds(spark):
    rows_ = training._assemble(spark.createDataFrame([(0, 0.0), (0, 2.0), (1, 10.0)], "part int, x double"), ["x"])
    models = [(0, "a", 0, 0, [[1.0], [99.0]]), (1, "a", 0, 1, [[10.0]]), (2, "a", 0, 2, [[5.0]])]
    totals, per = cluster.quality_by_set(rows_, training.FEATURES, "part", models)
    assert rows(totals) == [("a", 0, 3, 2.0, 2.0, 0.0)]
    assert rows(per, "fold", "cluster", "size", "withinss") == [(0, 0, 2, 2.0), (0, 1, 0, 0.0), (1, 0, 1, 0.0), (2, 0, 0, 0.0)]
    totals, per = cluster.quality_by_set(rows_.limit(0), training.FEATURES, "part", models)
    assert totals.count() == 0 and per.where("size > 0").count() == 0


def test_collinear_columns_go(spark, data):
    twin = data.withColumn("c", F.col("b") * 2 + 1)
    result = training.train_classifier(twin, "y", ["b", "c"], [], "LR", ["id"], {"alpha": [0], "lambda": [0]}, 1)
    assert result.model.predictor.numFeatures == 1


def test_collinear_slots_of_a_wide_table(spark):
    """At 2,500 slots two copies and a sum of others are found."""
    from pyspark.ml.linalg import Vectors

    n = 2_500
    draws = [{i % (n - 3): 1.0 + i % 3} for i in range(4 * n)]
    for d in draws:
        d |= {n - 3: d.get(0, 0.0), n - 2: 3 * d.get(7, 0.0), n - 1: d.get(1, 0.0) - d.get(2, 0.0)}
    df = spark.createDataFrame([(Vectors.sparse(n, d),) for d in draws], [training.FEATURES])
    kept = training.independent_slots(df, width=n)
    assert kept == list(range(n - 3))


def test_naive_bayes_formula(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 1), ("b", 5.0, 1), ("b", 4.0, 0), ("b", 6.0, 0),
                                ("a", None, 0), (None, 7.0, 0)], "f string, x double, y int")
    model = bayes.bayes_tables(df, "y", ["x"], ["f"])
    got = bayes.bayes_score(spark.createDataFrame([("a", 2.0), (None, None), ("new", 2.0)], "f string, x double"),
                            model, laplace=1.0).collect()

    def gauss(x, values):
        m = sum(values) / len(values)
        sd = math.sqrt(sum((v - m) ** 2 for v in values) / (len(values) - 1))
        return math.exp(-((x - m) / sd) ** 2 / 2) / sd
    prior = 3 / 4
    likelihood = gauss(2.0, [1, 3, 5]) / gauss(2.0, [4, 6, 7])
    factor = ((2 + 1) / (3 + 2)) / ((1 + 1) / (4 + 2))
    for r, odds in zip(got, [prior * likelihood * factor, prior, prior * likelihood]):
        assert r.p1 == pytest.approx(odds / (1 + odds))
    flat = spark.createDataFrame([(1.0, 1), (1.0, 1), (2.0, 0), (4.0, 0)], "x double, y int")
    floored = bayes.bayes_score(flat, bayes.bayes_tables(flat, "y", ["x"], []), min_sdev=0.5, eps_sdev=0.0)
    assert floored.first().p1 > 0.5


def test_hyper_parameter_rules():
    assert len(grids.combinations(grids.default_grid("LR", 9_000))) == 25
    assert len(grids.combinations(grids.default_grid("NB", 600_000))) == 8
    assert len(grids.combinations(grids.default_grid("GBM", 9_000))) == 16
    assert len(grids.combinations(grids.default_grid("RF", 50_000))) == 8
    assert grids.default_grid("KM", 100)["standardize"] == [True]
    assert grids.default_folds("DL", 600_000) == 1 and grids.default_folds("LR", 7_000) == 5
    assert grids.default_folds("KM", 5_000) == 5 and grids.default_folds("KM", 4_999) == 3
    with pytest.raises(ValueError, match="does not offer"):
        training.spark_params("DL", {"hidden": [3], "l1": 0.1}, 4)
    with pytest.raises(ValueError, match="no hyper-parameters"):
        training.spark_params("RF", {"depth": 3}, 4)


def test_unknown_algorithm(data):
    with pytest.raises(ValueError, match="unknown algorithm"):
        training.train_classifier(data, "y", NUMERIC, FACTORS, "XX", ["id"])


def test_assignment_ties_take_the_lowest(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    out = cluster.assign(df, ["x"], [[0.0], [2.0]])
    assert rows(out) == [(0.0, 0, 0.0), (1.0, 0, 1.0), (2.0, 1, 0.0)]
    totals, per = cluster.cluster_quality(out, ["x"])
    assert tuple(totals.first()) == pytest.approx((2.0, 1.0, 1.0))
