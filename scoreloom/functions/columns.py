"""Column expressions shared by the operators. All of them stay on the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")

# Critical values of the chi-square distribution with one degree
# of freedom, as (tail probability, critical value).
CHI_SQUARE_CRITICAL = (
    (0.001, 10.828),
    (0.002, 9.550),
    (0.005, 7.879),
    (0.01, 6.635),
    (0.02, 5.412),
    (0.025, 5.024),
    (0.05, 3.841),
    (0.10, 2.706),
    (0.20, 1.642),
    (0.975, 0.000982),
    (0.995, 0.0000393),
)


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def sample_deviation(value: Column) -> Column:
    """Sample standard deviation, exactly 0 for a constant.

    Merging partial moments leaves a rounding residue on constant columns, which
    a test for 0 would miss.
    """
    constant = (F.max(value) == F.min(value)) & (F.count(value) > 1)
    return F.when(constant, F.lit(0.0)).otherwise(F.stddev_samp(value))


# --------------------------------------------------------------------------
# row hashes: reproducible sampling that does not depend on partitioning
# --------------------------------------------------------------------------

def row_hash(keys: Sequence[str], stream: str) -> Column:
    """md5 of the stream name and the key columns, as 32 hexadecimal digits.

    Each kind of draw has a stream of its own. On one stream a split would find
    all rows of an earlier sample on the same side.
    """
    parts = [F.coalesce(column(k).cast("string"), F.lit("?")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(stream), *parts))


def hash_int(hashed: Column) -> Column:
    """The first eight hexadecimal digits as a number in [0, 2**32)."""
    return F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint")


def hash_share(keys: Sequence[str], stream: str) -> Column:
    """A reproducible uniform number in [0, 1) per row."""
    return hash_int(row_hash(keys, stream)) / F.lit(4294967296.0)


# --------------------------------------------------------------------------
# binning
# --------------------------------------------------------------------------

def cut_right_closed(df: DataFrame, breaks: dict[str, Sequence[float]],
                     prefix: str = "__bin_") -> DataFrame:
    """Add ``prefix + column`` with the 1-based bin of each listed column.

    Bins are right-closed and the lowest break belongs to the first bin. Values
    outside the breaks, NULL, and columns without breaks give NULL. A repeated
    break makes an empty bin, the first of the equal ones takes the values.

    The search is Spark ML's binary-search bucketizer. It is left-closed, so it
    runs on the negated column.
    """
    for name, points in breaks.items():
        target = prefix + name
        if not points:
            df = df.withColumn(target, F.lit(None).cast("int"))
            continue
        distinct = sorted(set(points))
        # bucket b of the negated column holds (distinct[-2-b], distinct[-1-b]],
        # counted after the leading bucket of values above the last break
        first_bin = {x: max(1, points.index(x)) for x in distinct}
        splits = [-INF] + [-x if x != 0 else -0.0 for x in reversed(distinct)] + [INF]
        bins: list[int | None] = [None]
        bins += [first_bin[x] for x in reversed(distinct[1:])] + [None]
        negated = "__neg_" + name
        df = df.withColumn(negated, -column(name).cast("double"))
        df = Bucketizer(splits=splits, inputCol=negated, outputCol=target + "_raw",
                        handleInvalid="keep").transform(df)
        lookup = F.array(*[F.lit(b).cast("int") for b in bins])
        raw = column(target + "_raw")
        # the lowest break itself falls in the last bucket after negation
        at_lowest = column(name).cast("double") == F.lit(distinct[0])
        df = df.withColumn(
            target,
            F.when(at_lowest, F.lit(1))
            .when(raw <= F.lit(float(len(bins) - 1)),
                  F.try_element_at(lookup, (raw + 1).cast("int"))),
        ).drop(negated, target + "_raw")
    return df


def grid_step(score: Column, points: int = 100) -> Column:
    """Largest k in [-1, points] with k/points <= score; exact on the doubles."""
    rough = F.floor(score * F.lit(float(points))).cast("int")
    scale = F.lit(float(points))
    exact = (F.when(score >= (rough + 1) / scale, rough + 1)
             .when(score < rough / scale, rough - 1)
             .otherwise(rough))
    return F.greatest(F.lit(-1), F.least(F.lit(points), exact)).cast("int")


def hundredth_bin(score: Column) -> Column:
    """The i with i*0.01 < score <= (i+1)*0.01, exact on the double products."""
    rough = (F.ceil(score * F.lit(100.0)) - 1).cast("int")
    width = F.lit(0.01)
    return (F.when(score > (rough + 1) * width, rough + 1)
            .when(score <= rough * width, rough - 1)
            .otherwise(rough)).cast("int")


# --------------------------------------------------------------------------
# weight of evidence and the two-by-two chi-square rule
# --------------------------------------------------------------------------

def weight_of_evidence(share_pos: Column, share_neg: Column) -> Column:
    """ln(share_pos/share_neg), smoothed only where one of the shares is zero."""
    smoothing = F.when((share_pos == 0) | (share_neg == 0),
                       (share_pos + share_neg) / F.lit(200.0)).otherwise(F.lit(0.0))
    return F.ln(F.try_divide(share_pos + smoothing, share_neg + smoothing))


def chi_square(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Chi-square of the table [[a, b], [c, d]] with the small-sample rules."""
    zeros = sum((x == 0).cast("int") for x in (a, b, c, d))
    total = a + b + c + d
    one_sided = ((b + d == 0) & (a > 0) & (c > 0)) | ((a + c == 0) & (b > 0) & (d > 0))
    margins = (a + b) * (c + d) * (a + c) * (b + d) + F.lit(0.1)
    cross = F.abs(a * d - b * c)
    small = F.least(a, b, c, d) < 5
    distance = F.when(small, cross - total / F.lit(2.0)).otherwise(cross)
    return (F.when((zeros == 4) | one_sided, F.lit(0.0))
            .when(zeros > 0, F.lit(100.0))
            .otherwise((distance * distance * total + F.lit(0.1)) / margins))


def p_value_floor(chi2: Column) -> Column:
    """Largest tabulated tail probability the statistic still reaches, else 0."""
    out = F.lit(0.0)
    for alpha, critical in CHI_SQUARE_CRITICAL:
        out = F.when(chi2 <= F.lit(critical), F.lit(alpha)).otherwise(out)
    return out


def p_value_ceiling(chi2: Column) -> Column:
    """Smallest tabulated tail probability at or beyond the statistic, else 1."""
    out = F.lit(1.0)
    for alpha, critical in reversed(CHI_SQUARE_CRITICAL):
        out = F.when(chi2 >= F.lit(critical), F.lit(alpha)).otherwise(out)
    return out


def merge_limit(p_threshold: float) -> float:
    """Two groups merge when chi-square is at most this critical value."""
    usable = [critical for alpha, critical in CHI_SQUARE_CRITICAL if alpha >= p_threshold]
    if not usable:
        raise ValueError(f"no tabulated tail probability at or above {p_threshold}")
    return max(usable)


# --------------------------------------------------------------------------
# classification rates
# --------------------------------------------------------------------------

# Names of the reported rates.
RATE_NAMES = ("f1", "f2", "f0point5", "accuracy", "precision", "recall", "specificity",
              "absolute_mcc", "min_per_class_accuracy", "mean_per_class_accuracy",
              "tnr", "fnr", "fpr", "tpr")


def classification_rates(tps: Column, fps: Column, tns: Column, fns: Column) -> dict[str, Column]:
    """Every rate of a confusion table; an undefined rate is 0."""
    tp, fp, tn, fn = (x.cast("double") for x in (tps, fps, tns, fns))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    precision = ratio(tp, tp + fp)
    tpr = ratio(tp, tp + fn)
    tnr = ratio(tn, tn + fp)

    def f_beta(square: float) -> Column:
        return ratio(F.lit(1.0 + square) * precision * tpr, F.lit(square) * precision + tpr)

    return {
        "f1": f_beta(1.0),
        "f2": f_beta(4.0),
        "f0point5": f_beta(0.25),
        "accuracy": ratio(tp + tn, tp + fp + tn + fn),
        "precision": precision,
        "recall": tpr,
        "specificity": tnr,
        "absolute_mcc": ratio(F.abs(tp * tn - fp * fn),
                              F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)),
        "min_per_class_accuracy": F.least(tpr, tnr),
        "mean_per_class_accuracy": (tpr + tnr) / F.lit(2.0),
        "tnr": tnr,
        "fnr": ratio(fn, tp + fn),
        "fpr": ratio(fp, tn + fp),
        "tpr": tpr,
    }
