"""K-means of many models in shared passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import training
from scoreloom.operators.kmeans import Wanted, centres_model, fit_centres, pack, reduce_candidates


def blobs(spark, n=3000):
    """Three groups far apart, one with a third of its rows the same."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        g = i % 3
        x, y = (100.0 * g, -50.0 * g) + rng.normal(size=2)
        rows.append((i, *((0.0, 0.0) if g == 0 and i % 9 == 0 else (float(x), float(y)))))
    return spark.createDataFrame(rows, "id long, x double, y double")


def test_passes_do_not_grow_with_the_grid(spark):
    df = spark.range(4000).select("id", F.rand(1).alias("x"), F.rand(2).alias("y")).repartition(3).cache()
    sc, jobs = spark.sparkContext, []
    for i, ks in enumerate(([2, 3], [2, 3, 4, 5, 6, 7])):
        sc.setJobGroup(f"kmeans grid {i}", "")
        training.train_kmeans(df, ["x", "y"], [], ["id"], {"k": ks, "max_iterations": [2], "standardize": [True]}, 2)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"kmeans grid {i}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 2


def test_groups_far_apart_are_found_in_all_models(spark):
    rows = training._assemble(blobs(spark).withColumn("part", (F.col("id") % 2).cast("int")), ["x", "y"])
    wanted = [Wanted(frozenset({0, 1}), 3, 10), Wanted(frozenset({1}), 3, 10), Wanted(frozenset({0}), 2, 0)]
    plain = fit_centres(rows, training.FEATURES, "part", wanted)
    packed = fit_centres(pack(rows, training.FEATURES, "part"), training.FEATURES, "part", wanted)
    for found in (plain, packed):
        for f in found[:2]:
            assert np.allclose(f.centres[f.centres[:, 0].argsort()], [[0, 0], [100, -50], [200, -100]], atol=0.5)
        assert found[2].centres.shape == (2, 2) and found[2].iterations == 0
    part = rows.where("part = 1 AND x BETWEEN 50 AND 150").agg(F.avg("x"), F.avg("y")).first()
    own = plain[1].centres
    assert np.allclose(own[own[:, 0].argsort()][1], list(part))


def test_model_of_given_centres_and_few_different_rows(spark):
    same = training._assemble(spark.range(50).selectExpr("0 AS part", "1.5D AS x", "2.5D AS y"), ["x", "y"])
    found = fit_centres(same, training.FEATURES, "part", [Wanted(frozenset({0}), 3, 5)])[0]
    assert found.centres.shape == (1, 2) and np.allclose(found.centres, [[1.5, 2.5]])
    given = np.array([[1.0, 2.0], [3.0, 4.0], [5.0, 7.0]])
    model = centres_model(same, training.FEATURES, given, 3)
    assert sorted(c.tolist() for c in model.clusterCenters()) == given.tolist()
    with pytest.raises(ValueError, match="no rows"):
        fit_centres(same, training.FEATURES, "part", [Wanted(frozenset({1}), 3, 5)])


def test_candidates_are_reduced_by_weight():
    points = np.array([[0.0], [1.0], [10.0], [11.0]])
    found = reduce_candidates(points, np.array([3, 1, 1, 1]), 2, np.random.default_rng(1))
    assert sorted(found[:, 0]) == [0.25, 10.5]
