import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from scoreloom.operators import score


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    out = [(rng.randrange(2), round(rng.random(), 2)) for _ in range(400)]
    # a third of the rows share one score
    return out + [(1, 0.0), (0, 1.0), (1, 1.0)] + [(int(i % 4 == 0), 0.37) for i in range(200)]


@pytest.fixture(scope="module")
def scored(spark, data):
    return spark.createDataFrame(data, "y int, p1 double").repartition(5)


@pytest.fixture(scope="module")
def steps(scored):
    return score.score_steps(score.score_counts(scored)).cache()


def table(data, t):
    tp = sum(y for y, p in data if p >= t)
    fp = sum(1 - y for y, p in data if p >= t)
    P = sum(y for y, _ in data)
    return tp, fp, len(data) - P - fp, P - tp


def test_steps_against_brute_force(data, steps):
    got = steps.orderBy("idx").collect()
    assert [r.p1 for r in got] == sorted({p for _, p in data}, reverse=True)
    for i, r in enumerate(got):
        assert (r.tps, r.fps, r.tns, r.fns) == table(data, r.p1) and r.idx == i


def test_grid_sums_to_all_rows(data, scored):
    grid = score.threshold_grid(score.score_counts(scored)).collect()
    assert len(grid) == 101
    for r in grid:
        assert (r.tps, r.fps, r.tns, r.fns) == table(data, r.threshold)


def test_ks_and_auc(data, scored, steps):
    P = sum(y for y, _ in data)
    gaps = {p: table(data, p)[0] / P - table(data, p)[1] / (len(data) - P) for _, p in data}
    best = max(gaps.values())
    ks = score.ks_exact(steps).first()
    assert ks.ks == pytest.approx(best)
    assert ks.ks_threshold == min(p for p, g in gaps.items() if g == best)
    got = score.overall_metrics(steps, parameters=3).first()
    expected = BinaryClassificationEvaluator(rawPredictionCol="p1", labelCol="y", numBins=0).evaluate(scored)
    assert got.auc == pytest.approx(expected, abs=1e-12)
    mse = sum((y - p) ** 2 for y, p in data) / len(data)
    loss = 0.0
    for y, p in data:
        q = min(max(p, 1e-15), 1 - 1e-15)
        loss -= math.log(q) if y else math.log(1 - q)
    assert got.mse == pytest.approx(mse) and got.logloss == pytest.approx(loss / len(data))
    assert got.aic == pytest.approx(2 * loss + 6)
    rate = P / len(data)
    assert got.r2 == pytest.approx(1 - mse / (rate * (1 - rate)))


def test_top_n_takes_first_threshold(data, steps):
    got = {r.score_top: r for r in score.top_n(steps).collect()}
    assert len(got) == 10
    for i in range(1, 11):
        goal = i * len(data) // 10
        threshold = max(p for _, p in data if sum(table(data, p)[:2]) >= goal)
        assert got[f"Top{10 * i}%"].threshold == threshold


def test_gains_lift_totals(data, steps):
    got = score.gains_lift(steps).orderBy("group").collect()
    assert got[-1].cumulative_data_fraction == pytest.approx(1.0)
    assert got[-1].cumulative_capture_rate == pytest.approx(1.0)
    assert got[-1].cumulative_lift == pytest.approx(1.0)
    assert sum(r.capture_rate for r in got) == pytest.approx(1.0)


def test_best_thresholds(data, steps):
    got = {r.metric: r for r in score.best_thresholds(steps).collect()}

    def f1(t):
        tp, fp, tn, fn = table(data, t)
        return 2 * tp / (2 * tp + fp + fn) if tp else 0.0
    assert got["f1"].value == pytest.approx(max(f1(p) for _, p in data))
    assert set(got) == set(score.BEST_METRICS)


def test_bands_and_confusion(data, scored):
    grid = score.threshold_grid(score.score_counts(scored))
    groups = score.score_groups(grid).collect()
    assert len(groups) == 110
    for cut in (0.0, 0.5, 1.0):
        part = [r for r in groups if r.cut == cut]
        assert sum(r.tps + r.fps + r.tns + r.fns for r in part) == len(data)
        assert sum(r.fraction for r in part) == pytest.approx(1.0)
    half = {r.actual: r for r in score.confusion_at(grid, [0.5]).collect()}
    tp, fp, tn, fn = table(data, 0.5)
    assert half["0"].error == pytest.approx(fp / (fp + tn)) and half["1"].error == pytest.approx(fn / (fn + tp))
    assert half["Total"].rate == f"({fp + fn} / {len(data)})"


@pytest.mark.parametrize("size", [31, 40, 100, 275])
def test_thinning_takes_the_first_row_of_each_run(spark, size):
    picked = {r.id for r in spark.range(size).where(score.opens_run(F.col("id"), size, 20)).collect()}
    assert picked == {next(i for i in range(size) if i * 20 // size == run) for run in range(20)}


def test_one_sided_labels_do_not_fail(spark):
    only = spark.createDataFrame([(1, 0.3), (1, 0.9)], "y int, p1 double")
    report = score.classification_report(only)
    assert report["overall_metrics"].first().auc is None
    for df in report.values():
        df.collect()


def test_histogram_drops_exact_zero(scored, data):
    got = score.score_histogram(scored)
    assert got.count() == 100
    assert got.agg(F.sum("n")).first()[0] == sum(p > 0 for _, p in data)
