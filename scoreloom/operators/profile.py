"""Column and row profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.columns import column, sample_deviation
from scoreloom.functions.reshape import stack_rows, to_long
from scoreloom.functions.staging import stage
from scoreloom.operators.quantile import medians
from scoreloom.operators.sample import sample_n, sample_share


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, max, min, mean, sigma, median, missing_count)``, NULLs skipped."""
    wide = df.agg(*[
        f(column(c).cast("double")).alias(f"{tag}{i}")
        for i, c in enumerate(columns)
        for tag, f in (("max", F.max), ("min", F.min), ("mean", F.avg), ("sd", sample_deviation))
    ], *[F.count_if(column(c).isNull()).alias("null%d" % i) for i, c in enumerate(columns)])
    rows = [{"variable": F.lit(c), "max": F.col("max%d" % i), "min": F.col("min%d" % i),
             "mean": F.col("mean%d" % i), "sigma": F.col("sd%d" % i),
             "missing_count": F.col("null%d" % i)} for i, c in enumerate(columns)]
    # both sides have one row per column of the table
    return (stack_rows(wide, rows).join(F.broadcast(medians(df, columns)), "variable", "left")
            .select("variable", "max", "min", "mean", "sigma", "median", "missing_count"))


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, level, n)``: rows per level, NULL being a level of its own."""
    long = to_long(df, {c: column(c).cast("string") for c in columns}, value="level")
    return long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))


def factor_profile(df: DataFrame, columns: Sequence[str], join_up_to: int = 10_000,
                   counts: DataFrame | None = None) -> DataFrame:
    """``(variable, level_num, missing_count, most_freq_level, levels)``.

    ``levels`` is the sorted level list joined with a pipe sign. A list longer
    than ``join_up_to`` levels is not put into one cell: the cell is NULL and
    :func:`level_domain` holds the whole list as rows.
    """
    # read four times below: staged, or the table would be scanned each time
    counts = stage(level_counts(df, columns), "levels") if counts is None else counts
    level, n = F.col("level"), F.col("n")
    present = level.isNotNull()
    summary = counts.groupBy("variable").agg(
        F.count("level").alias("level_num"),
        F.coalesce(F.sum(F.when(~present, n)), F.lit(0)).alias("missing_count"),
        # most rows first, the smallest level among equals
        F.max(F.when(present, n)).alias("__top"))
    # one row per column of the table
    ranked = counts.join(F.broadcast(summary), "variable")
    modes = ranked.where(present & (n == F.col("__top"))).groupBy("variable").agg(
        F.min("level").alias("most_freq_level"))
    joined = (ranked.where(present & (F.col("level_num") <= join_up_to)).groupBy("variable")
              .agg(F.concat_ws("|", F.array_sort(F.collect_list("level"))).alias("levels")))
    return (summary.join(F.broadcast(modes), "variable", "left")
            .join(F.broadcast(joined), "variable", "left")
            .select("variable", "level_num", "missing_count", "most_freq_level", "levels"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """``(label, n)``: rows per label, also the frequency table of any column."""
    return df.groupBy(column(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def missing_in_row(variables: Sequence[str]) -> Column:
    """Number of NULL cells of a row over the given variables."""
    return sum((column(c).isNull().cast("int") for c in variables), F.lit(0))


def row_missing(df: DataFrame, variables: Sequence[str], name: str = "n_missing") -> DataFrame:
    return df.withColumn(name, missing_in_row(variables))


def column_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, missing_count)``."""
    wide = df.agg(*[F.count_if(column(c).isNull()).alias("n%d" % i) for i, c in enumerate(columns)])
    return stack_rows(wide, [{"variable": F.lit(c), "missing_count": F.col("n%d" % i)}
                             for i, c in enumerate(columns)])


def column_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, sigma)``: sample standard deviation, NULLs skipped."""
    wide = df.agg(*[sample_deviation(column(c).cast("double")).alias("s%d" % i)
                    for i, c in enumerate(columns)])
    return stack_rows(wide, [{"variable": F.lit(c), "sigma": F.col("s%d" % i)}
                             for i, c in enumerate(columns)])


def level_domain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, level)``: the distinct levels as rows, any number of them."""
    return level_counts(df, columns).where(F.col("level").isNotNull()).select("variable", "level")


def profile_input(df: DataFrame, sampling, keys: Sequence[str], seed: int = 1) -> DataFrame:
    """The rows a profile is computed on.

    ``sampling`` is falsy (all rows), a share below 1, a number of rows, or
    ``"auto"``: above 10,000 rows take 10,000 rows of a table wider than 500
    columns, else 20,000. A number at or above the table size means all rows.
    """
    if not sampling:
        return df
    if isinstance(sampling, float):
        if not 0 < sampling < 1:
            raise ValueError("a sampling share lies between 0 and 1")
        return sample_share(df, sampling, keys, seed)
    rows = df.count()
    if sampling == "auto":
        if rows <= 10_000:
            return df
        size = 10_000 if len(df.columns) > 500 else 20_000
    else:
        size = int(sampling)
    return df if size >= rows else sample_n(df, size, keys, seed)
