"""Threshold, ranking and loss metrics of a scored table ``(y, p1)``.

One group-by collapses the rows to distinct scores with their positive and
negative counts; it combines on the map side, so a score shared by very many
rows is one row per task. Everything else reads that table: the 101-point grid
groups it again, the exact curves read running totals computed slice by slice.
Rows are predicted positive when ``p1 >= threshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import (
    RATE_NAMES, classification_rates, column, grid_step, hundredth_bin)
from scoreloom.functions.ordered import ordered_totals
from scoreloom.functions.staging import stage

GRID = 100
# Default metrics of the best-threshold table.
BEST_METRICS = ("min_per_class_accuracy", "absolute_mcc", "precision", "recall", "specificity",
                "accuracy", "f0point5", "f2", "f1", "mean_per_class_accuracy")
# Shares of the best scores that close the gains/lift groups.
GAINS_SHARES = (0.01, 0.02, 0.03, 0.04, 0.05, 0.10, 0.15, 0.20,
                0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90, 1.00)
# Columns of the score-band tables.
BAND_METRICS = ("tps", "fps", "tns", "fns", "recall", "precision", "accuracy", "specificity")


def score_counts(scored: DataFrame, y: str = "y", p: str = "p1", group: Sequence[str] = ()) -> DataFrame:
    """``(group.., p1, pos, neg)``: rows per distinct score of each group (a set, a fold, a grid point)."""
    return (scored.where(column(y).isNotNull() & column(p).isNotNull())
            .groupBy(*[column(g) for g in group], column(p).cast("double").alias("p1"))
            .agg(F.sum(column(y).cast("bigint")).alias("pos"),
                 F.sum(1 - column(y).cast("bigint")).alias("neg")))


def score_steps(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, as a threshold: ``idx`` 0.. from the top score,
    ``pos``/``neg`` at the score, ``tps``/``fps`` at or above it, ``all_pos``/``all_neg`` in all,
    each within its group; one range-partitioned pass serves all groups.
    """
    running = ordered_totals(
        counts.select(*[column(g) for g in group], "p1", "pos", "neg"), [F.col("p1").desc()],
        {"tps": F.col("pos"), "fps": F.col("neg"), "idx": F.lit(1).cast("bigint")},
        group=group, whole={"tps": "all_pos", "fps": "all_neg"})
    return (running.withColumn("idx", F.col("idx") - 1)
            .withColumn("tns", F.col("all_neg") - F.col("fps"))
            .withColumn("fns", F.col("all_pos") - F.col("tps")))


def _with_rates(df: DataFrame, names: Sequence[str] = RATE_NAMES) -> DataFrame:
    rates = classification_rates(*[F.col(c) for c in ("tps", "fps", "tns", "fns")])
    return df.withColumns({n: rates[n] for n in names})


# --------------------------------------------------------------------------
# grids
# --------------------------------------------------------------------------

def score_histogram(scored: DataFrame, p: str = "p1") -> DataFrame:
    """``(bin, low, high, n)``: 100 right-closed bins, an exact 0 falls out."""
    spark = scored.sparkSession
    seen = (scored.select(hundredth_bin(column(p).cast("double")).alias("bin"))
            .where(F.col("bin").between(0, GRID - 1)).groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    bins = spark.range(GRID).select(F.col("id").cast("int").alias("bin"))
    return (bins.join(F.broadcast(seen), "bin", "left")  # at most 100 rows
            .select("bin", (F.col("bin") * F.lit(0.01)).alias("low"),
                    ((F.col("bin") + 1) * F.lit(0.01)).alias("high"),
                    F.coalesce("n", F.lit(0)).alias("n")))


def threshold_grid(counts: DataFrame, points: int = GRID) -> DataFrame:
    """``(threshold, tps, fps, tns, fns)`` at 0.00, 0.01 .. 1.00."""
    spark = counts.sparkSession
    cells = (counts.groupBy(grid_step(F.col("p1"), points).alias("k"))
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    steps = spark.range(-1, points + 1).select(F.col("id").cast("int").alias("k"))
    zero = F.lit(0).cast("bigint")
    dense = steps.join(F.broadcast(cells), "k", "left").select(  # at most points + 2 rows
        "k", F.coalesce("pos", zero).alias("pos"), F.coalesce("neg", zero).alias("neg"))
    at_or_above = W.partitionBy(F.lit(0)).orderBy(F.desc("k")).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(F.lit(0))
    return (dense
            .withColumn("tps", F.sum("pos").over(at_or_above))
            .withColumn("fps", F.sum("neg").over(at_or_above))
            .withColumn("fns", F.sum("pos").over(whole) - F.col("tps"))
            .withColumn("tns", F.sum("neg").over(whole) - F.col("fps"))
            .where(F.col("k") >= 0)
            .select((F.col("k") / F.lit(float(points))).alias("threshold"),
                    "tps", "fps", "tns", "fns"))


def threshold_rates(grid: DataFrame) -> DataFrame:
    """Grid counts with every rate."""
    return _with_rates(grid)


def ks_on_grid(grid: DataFrame) -> DataFrame:
    """``(ks, ks_threshold)``: largest tpr - fpr on the grid, not below 0."""
    gap = (F.col("tpr") - F.col("fpr")).alias("gap")
    best = _with_rates(grid, ["tpr", "fpr"]).agg(
        F.max(F.struct(gap, (-F.col("threshold")).alias("neg_t"))).alias("b"))
    positive = F.col("b.gap") > 0
    return best.select(F.when(positive, F.col("b.gap")).otherwise(F.lit(0.0)).alias("ks"),
                       F.when(positive, -F.col("b.neg_t")).otherwise(F.lit(0.0)).alias("ks_threshold"))


def confusion_at(grid: DataFrame, thresholds: Sequence[float] | None = None) -> DataFrame:
    """Confusion matrices in rows: ``(threshold, actual, predicted_0, predicted_1, error, rate)``.

    Without ``thresholds`` every grid point below 1 is reported.
    """
    if thresholds is None:
        grid = grid.where(F.col("threshold") < 1)
    else:
        grid = grid.where(F.col("threshold").isin(*[round(t, 2) for t in thresholds]))
    tp, fp, tn, fn = (F.col(c) for c in ("tps", "fps", "tns", "fns"))

    def line(actual: str, zero: Column, one: Column, wrong: Column, of: Column) -> Column:
        rate = F.concat(F.lit("("), wrong.cast("string"), F.lit(" / "), of.cast("string"), F.lit(")"))
        return F.struct(F.lit(actual).alias("actual"), zero.alias("predicted_0"),
                        one.alias("predicted_1"), F.try_divide(wrong, of).alias("error"),
                        rate.alias("rate"))

    lines = F.array(line("0", tn, fp, fp, tn + fp), line("1", fn, tp, fn, tp + fn),
                    line("Total", tn + fn, fp + tp, fp + fn, tn + fn + fp + tp))
    return grid.select("threshold", F.inline(lines))


def score_groups(grid: DataFrame) -> DataFrame:
    """Ten score bands for each of the cuts 0.0, 0.1 .. 1.0.

    A band at or above the cut counts as predicted positive, one below as
    predicted negative. The top band includes a score of 1.
    """
    tenth = F.round(F.col("threshold") * 10, 6)
    tens = grid.where(tenth == F.floor(tenth)).select(
        F.floor(tenth).cast("int").alias("j"), "tps", "fps",
        (F.col("tps") + F.col("fps") + F.col("tns") + F.col("fns")).alias("total"))
    w = W.partitionBy(F.lit(0)).orderBy("j")  # 11 rows
    zero = F.lit(0).cast("bigint")
    # nothing lies above the top band, whose upper end is closed
    bands = tens.withColumn("up_tps", F.when(F.col("j") < 9, F.lead("tps").over(w)).otherwise(zero)) \
        .withColumn("up_fps", F.when(F.col("j") < 9, F.lead("fps").over(w)).otherwise(zero)) \
        .where(F.col("j") < 10) \
        .select("j", "total", (F.col("tps") - F.col("up_tps")).alias("pos"),
                (F.col("fps") - F.col("up_fps")).alias("neg"))
    cuts = bands.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(10))))  # 10 x 11 rows
    hit = F.col("j") >= F.col("i")
    pos, neg = F.col("pos"), F.col("neg")
    zero_d = F.lit(0.0)
    share_pos = F.coalesce(F.try_divide(pos, pos + neg), zero_d)
    share_neg = F.coalesce(F.try_divide(neg, pos + neg), zero_d)
    return cuts.select(
        (F.col("i") / F.lit(10.0)).alias("cut"),
        F.concat((F.col("j") / F.lit(10.0)).cast("string"), F.lit("-"),
                 ((F.col("j") + 1) / F.lit(10.0)).cast("string")).alias("score_band"),
        F.try_divide(pos + neg, F.col("total")).alias("fraction"),
        F.when(hit, pos).otherwise(zero).alias("tps"), F.when(hit, neg).otherwise(zero).alias("fps"),
        F.when(hit, zero).otherwise(neg).alias("tns"), F.when(hit, zero).otherwise(pos).alias("fns"),
        F.when(hit & (pos > 0), F.lit(1.0)).otherwise(zero_d).alias("recall"),
        F.when(hit, share_pos).otherwise(zero_d).alias("precision"),
        F.when(hit, share_pos).otherwise(share_neg).alias("accuracy"),
        F.when(~hit & (neg > 0), F.lit(1.0)).otherwise(zero_d).alias("specificity"))


# --------------------------------------------------------------------------
# exact curves
# --------------------------------------------------------------------------

def ks_exact(steps: DataFrame) -> DataFrame:
    """``(ks, ks_threshold, ks_idx)`` over every observed score, lowest threshold on ties."""
    return _ks_and_size(steps).drop("size")


def _ks_and_size(steps: DataFrame) -> DataFrame:
    gap = F.try_divide(F.col("tps"), F.col("all_pos")) - F.try_divide(F.col("fps"), F.col("all_neg"))
    best = steps.agg(F.count(F.lit(1)).alias("size"),
                     F.max(F.struct(gap.alias("gap"), (-F.col("p1")).alias("neg_t"), F.col("idx"))).alias("b"))
    return best.select("size", F.col("b.gap").alias("ks"), (-F.col("b.neg_t")).alias("ks_threshold"),
                       F.col("b.idx").alias("ks_idx"))


def opens_run(idx: Column, size: int, wanted: int) -> Column:
    """Whether row ``idx`` (from 0) is the first of one of ``wanted`` runs that cut ``size`` rows evenly."""
    return F.pmod(idx * wanted, F.lit(size)) < wanted


def thinned_steps(steps: DataFrame, wanted: int = 20) -> DataFrame:
    """The first row of each of ``wanted`` even runs of the thresholds, and the KS row; all of a short table."""
    shape = _ks_and_size(steps).first()
    if shape["size"] > wanted + 10:
        steps = steps.where(opens_run(F.col("idx"), shape["size"], wanted) | (F.col("idx") == shape["ks_idx"]))
    rated = _with_rates(steps).withColumn("tpr_fpr", F.col("tpr") - F.col("fpr"))
    return rated.select("idx", F.col("p1").alias("threshold"), "tps", "fps", "tns", "fns",
                        *RATE_NAMES, "tpr_fpr")


def top_n(steps: DataFrame) -> DataFrame:
    """The first threshold that covers each tenth of the rows, with its counts."""
    rows = F.col("all_pos") + F.col("all_neg")
    covered = F.col("tps") + F.col("fps")
    before = covered - F.col("pos") - F.col("neg")
    tenths = F.sequence(F.lit(1), F.lit(10))

    def reached_here(i: Column) -> Column:
        goal = F.greatest(F.floor(i * rows / 10), F.lit(1))
        return (goal > before) & (goal <= covered)

    hit = steps.select("*", F.explode(F.filter(tenths, reached_here)).alias("i"))
    return _with_rates(hit, ["recall", "precision", "accuracy", "specificity"]).select(
        F.concat(F.lit("Top"), (F.col("i") * 10).cast("string"), F.lit("%")).alias("score_top"),
        F.col("p1").alias("threshold"), *BAND_METRICS)


def _score_quantiles(steps: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``(share, threshold)``: interpolated score quantile at 1 - share."""
    rows = F.col("all_pos") + F.col("all_neg")
    stop = rows - (F.col("tps") + F.col("fps") - F.col("pos") - F.col("neg"))
    start = rows - (F.col("tps") + F.col("fps"))
    wanted = F.array(*[F.struct(F.lit(s).alias("share"), F.lit(round(1 - s, 10)).alias("prob"))
                       for s in shares])

    def near(w: Column) -> Column:
        k = F.floor(w["prob"] * (rows - 1))
        return ((k >= start) & (k < stop)) | ((k + 1 >= start) & (k + 1 < stop))

    # at most two score rows per share
    hit = steps.select("p1", rows.alias("rows"), start.alias("start"), stop.alias("stop"),
                       F.explode(F.filter(wanted, near)).alias("w"))
    k = F.floor(F.col("w.prob") * (F.col("rows") - 1))
    nxt = F.least(k + 1, F.col("rows") - 1)
    ends = hit.groupBy("w", "rows").agg(
        F.max(F.when((k >= F.col("start")) & (k < F.col("stop")), F.col("p1"))).alias("v0"),
        F.max(F.when((nxt >= F.col("start")) & (nxt < F.col("stop")), F.col("p1"))).alias("v1"))
    weight = F.col("w.prob") * (F.col("rows") - 1) - k
    return ends.select(F.col("w.share").alias("share"),
                       (F.col("v0") + (F.col("v1") - F.col("v0")) * weight).alias("threshold"))


def gains_lift(steps: DataFrame) -> DataFrame:
    """Gains and lift by score groups that close at fixed shares of the best scores."""
    # one number per share
    cuts = {r["share"]: r["threshold"] for r in _score_quantiles(steps, GAINS_SHARES).collect()}
    number = F.lit(len(GAINS_SHARES))
    for i in range(len(GAINS_SHARES) - 1, 0, -1):
        number = F.when(F.col("p1") >= F.lit(cuts[GAINS_SHARES[i - 1]]), F.lit(i)).otherwise(number)
    groups = steps.withColumn("group", number).groupBy("group").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.sum(F.col("p1") * (F.col("pos") + F.col("neg"))).alias("score_sum"),
        F.min("p1").alias("lower_threshold"), F.max("all_pos").alias("all_pos"), F.max("all_neg").alias("all_neg"))
    w = W.partitionBy(F.lit(0)).orderBy("group").rowsBetween(W.unboundedPreceding, W.currentRow)
    n = F.col("pos") + F.col("neg")
    rows = F.col("all_pos") + F.col("all_neg")
    base = F.col("all_pos") / rows
    cum = (groups.withColumn("n", n).withColumn("cum_pos", F.sum("pos").over(w))
           .withColumn("cum_neg", F.sum("neg").over(w)).withColumn("cum_score", F.sum("score_sum").over(w))
           .withColumn("cum_n", F.col("cum_pos") + F.col("cum_neg")))
    ratio = F.try_divide
    response, cum_response = ratio(F.col("pos"), F.col("n")), ratio(F.col("cum_pos"), F.col("cum_n"))
    lift, cum_lift = ratio(response, base), ratio(cum_response, base)
    capture = ratio(F.col("cum_pos"), F.col("all_pos"))
    return cum.select(
        "group", (F.col("cum_n") / rows).alias("cumulative_data_fraction"), "lower_threshold",
        lift.alias("lift"), cum_lift.alias("cumulative_lift"), response.alias("response_rate"),
        ratio(F.col("score_sum"), F.col("n")).alias("score"),
        cum_response.alias("cumulative_response_rate"),
        ratio(F.col("cum_score"), F.col("cum_n")).alias("cumulative_score"),
        ratio(F.col("pos"), F.col("all_pos")).alias("capture_rate"),
        capture.alias("cumulative_capture_rate"), (F.lit(100.0) * (lift - 1)).alias("gain"),
        (F.lit(100.0) * (cum_lift - 1)).alias("cumulative_gain"),
        (capture - ratio(F.col("cum_neg"), F.col("all_neg"))).alias("kolmogorov_smirnov"))


def best_thresholds(steps: DataFrame, metrics: Sequence[str] = BEST_METRICS) -> DataFrame:
    """``(metric, threshold, value, idx)``: the best value of each metric, lowest threshold on ties."""
    rates = classification_rates(*[F.col(c) for c in ("tps", "fps", "tns", "fns")])
    best = steps.agg(*[
        F.max(F.struct(rates[m].alias("value"), (-F.col("p1")).alias("neg_t"), F.col("idx"))).alias(m)
        for m in metrics])
    packed = F.array(*[F.struct(F.lit(m).alias("metric"), (-F.col(m)["neg_t"]).alias("threshold"),
                                F.col(m)["value"].alias("value"), F.col(m)["idx"].alias("idx"))
                       for m in metrics])
    return best.select(F.inline(packed))


def max_criteria(steps: DataFrame) -> DataFrame:
    """The max-criteria table: ``(metric, threshold, value, idx)`` over all rates."""
    return best_thresholds(steps, RATE_NAMES)


def overall_metrics(steps: DataFrame, parameters: int | None = None, group: Sequence[str] = ()) -> DataFrame:
    """One row per group: nobs, MSE, RMSE, logloss, r2, AUC, Gini and, given the number of
    fitted parameters of a linear model, AIC.
    """
    keys = [column(g) for g in group]
    p, pos, neg = F.col("p1"), F.col("pos"), F.col("neg")
    clipped = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), p))
    sums = steps.groupBy(*keys).agg(
        F.max("all_pos").alias("all_pos"), F.max("all_neg").alias("all_neg"),
        F.sum(pos * (1 - p) * (1 - p) + neg * p * p).alias("sse"),
        F.sum(-(pos * F.ln(clipped) + neg * F.ln(1 - clipped))).alias("loss"),
        F.sum(neg * (F.col("tps") - pos / 2)).alias("area"))
    n = (F.col("all_pos") + F.col("all_neg")).cast("double")
    mse = F.col("sse") / n
    rate = F.col("all_pos") / n
    auc = F.try_divide(F.col("area"), F.col("all_pos").cast("double") * F.col("all_neg"))
    aic = (F.lit(2.0) * F.col("loss") + F.lit(2.0 * parameters)) if parameters is not None \
        else F.lit(None).cast("double")
    return sums.select(*keys, n.cast("bigint").alias("nobs"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
                       (F.col("loss") / n).alias("logloss"),
                       (1 - F.try_divide(mse, rate * (1 - rate))).alias("r2"),
                       auc.alias("auc"), (2 * auc - 1).alias("gini"), aic.alias("aic"))


def metrics_by(scored: DataFrame, group: Sequence[str], y: str = "y", p: str = "p1") -> DataFrame:
    """The overall metrics of every group of scored rows, all from one pass over the rows."""
    return overall_metrics(score_steps(score_counts(scored, y, p, group), group), group=group)


def metric_set(scored: DataFrame, which: str, name: str = "split") -> DataFrame:
    """The scored rows of one set: train, valid or xval."""
    return scored.where(column(name) == F.lit(which)).drop(name)


def classification_report(scored: DataFrame, y: str = "y", p: str = "p1",
                          parameters: int | None = None) -> dict[str, DataFrame]:
    """Every table of the classification report, from one pass over the rows."""
    steps = stage(score_steps(score_counts(scored, y, p)), "steps")
    grid = stage(threshold_grid(steps.select("p1", "pos", "neg")), "grid")
    rates = threshold_rates(grid)
    return {
        "overall_metrics": overall_metrics(steps, parameters),
        "metrics_at_half": rates.where(F.col("threshold") == 0.5),
        "best_thresholds": best_thresholds(steps),
        "gains_lift": gains_lift(steps),
        "max_criteria": max_criteria(steps),
        "threshold_metrics": rates,
        "ks": ks_on_grid(grid),
        "ks_exact": ks_exact(steps),
        "confusion_matrices": confusion_at(grid),
        "confusion_at_half": confusion_at(grid, [0.5]),
        "score_groups": score_groups(grid),
        "top_n": top_n(steps),
    }
