"""Running totals and ranks over a whole table without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.functions.staging import stage


def ordered_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, Column],
                   group: Sequence[str] = (), whole: dict[str, str] | None = None) -> DataFrame:
    """Add inclusive running totals in the given order, within ``group``.

    ``whole`` maps a total to a further column with its sum over the group.

    The rows are range-partitioned on (group, order), adaptive execution picking
    the number of slices, and staged together with the number of their slice,
    which fixes the slice of each row. Slice totals (at most slices + number of
    groups rows) give every
    slice its starting value, and a window inside one slice adds the rest. No
    task sees more than one slice, however large a single group is; rows equal
    in all order columns must have been collapsed before.
    """
    keys = [column(g) for g in group]
    for name, value in totals.items():
        df = df.withColumn(name, value)
    staged = stage(
        df.repartitionByRange(*keys, *order)
        .withColumn("__slice", F.spark_partition_id()), "ordered")

    starts = staged.groupBy(*keys, "__slice").agg(
        *[F.sum(column(name)).alias("__sum_" + name) for name in totals])
    before = W.partitionBy(*keys).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    whole = whole or {}
    starts = starts.select(
        *keys, "__slice",
        *[F.sum("__sum_" + name).over(W.partitionBy(*keys)).alias(out)
          for name, out in whole.items()],
        *[F.coalesce(F.sum("__sum_" + name).over(before), F.lit(0)).alias("__start_" + name)
          for name in totals])

    inside = W.partitionBy(*keys, "__slice").orderBy(*order).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    for g in group:
        starts = starts.withColumnRenamed(g, "__g_" + g)
    starts = starts.withColumnRenamed("__slice", "__at")
    matched = staged["__slice"] == starts["__at"]
    for g in group:
        matched = matched & column(g).eqNullSafe(column("__g_" + g))
    # proven bound: at most slices + number of groups rows, groups are variables
    joined = staged.join(F.broadcast(starts), matched, "inner")
    for name in totals:
        joined = joined.withColumn(
            name, F.sum(column(name)).over(inside) + column("__start_" + name))
    return joined.drop("__slice", "__at", *["__g_" + g for g in group],
                       *["__start_" + name for name in totals])
