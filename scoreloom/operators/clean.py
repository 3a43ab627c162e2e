"""Row and column cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.operators.profile import missing_in_row
from scoreloom.operators.woe import category_text


def drop_sparse_rows(df: DataFrame, variables: Sequence[str], max_missing_share: float) -> DataFrame:
    """Drop rows with more than ``int(len(variables) * share)`` NULL cells."""
    limit = int(len(variables) * max_missing_share)
    return df.where(missing_in_row(variables) <= F.lit(limit))


def droppable_variables(numeric: DataFrame | None, factor: DataFrame | None, rows: int,
                        max_levels: float, max_missing_share: float) -> DataFrame:
    """``(variable, reason)`` read off the profiles (one row per column of the table).

    Reasons: ``sparse``, ``too_many_levels``, ``constant_factor``,
    ``constant_numeric``. ``max_levels`` is a share of the rows up to 1, a count
    above. ``rows`` is the number of rows the profiles were computed on.
    """
    level_limit = int(rows * max_levels) if max_levels <= 1 else max_levels
    sparse_limit = int(rows * max_missing_share)
    sparse = F.when(F.col("missing_count") >= sparse_limit, F.lit("sparse"))
    complete = F.col("missing_count") == 0
    found = []
    if factor is not None:
        found.append((factor, [
            sparse,
            F.when(F.col("level_num") > level_limit, F.lit("too_many_levels")),
            F.when((F.col("level_num") == 1) & complete, F.lit("constant_factor"))]))
    if numeric is not None:
        found.append((numeric, [
            sparse, F.when((F.col("sigma") == 0) & complete, F.lit("constant_numeric"))]))
    if not found:
        raise ValueError("no profile given")
    out = None
    for profile, reasons in found:
        rows_out = profile.select("variable", F.explode(F.array(*reasons)).alias("reason")).where(
            F.col("reason").isNotNull())
        out = rows_out if out is None else out.unionByName(rows_out)
    return out


def drop_variables(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def fill_missing(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace NULL by a literal per column; the column keeps its type."""
    kinds = dict(df.dtypes)
    filled = {c: F.coalesce(column(c), F.lit(v).cast(kinds[c]))
              for c, v in values.items() if c in kinds and v is not None}
    return df.select(*[filled[c].alias(c) if c in filled else column(c) for c in df.columns])


def learned_fill(numeric: DataFrame | None, factor: DataFrame | None) -> DataFrame:
    """``(variable, fill_value)``: median of numerics, most frequent level of factors."""
    out = None
    if numeric is not None:
        out = numeric.select("variable", F.col("median").cast("string").alias("fill_value"))
    if factor is not None:
        modes = factor.select("variable", F.col("most_freq_level").alias("fill_value"))
        out = modes if out is None else out.unionByName(modes)
    return out


def fill_values(learned: DataFrame | None, given: dict[str, object] | None) -> dict[str, object]:
    """Merge learned values with the user's own, which win."""
    values: dict[str, object] = {}
    if learned is not None:
        values = {r["variable"]: r["fill_value"] for r in learned.collect()}
    values.update({c: v for c, v in (given or {}).items() if v is not None})
    return values


def as_categories(df: DataFrame, *names: str | None) -> DataFrame:
    """Cast id and label to text categories."""
    return df.withColumns({n: category_text(df, n) for n in names if n})


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[column(n) for n in names])


def rows_with_level(df: DataFrame, name: str, level) -> DataFrame:
    return df.where(column(name) == F.lit(level))
