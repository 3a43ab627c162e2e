"""Wide-to-long helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.columns import column


def to_long(df: DataFrame, values: dict[str, Column], carry: Sequence[str] = (),
            name: str = "variable", value: str = "value") -> DataFrame:
    """One row per (row, variable), only the carried columns kept beside them."""
    carried = [column(c) for c in carry]
    wide = df.select(*carried, *[v.alias(n) for n, v in values.items()])
    return wide.unpivot(carried, [column(n) for n in values], name, value)


def stack_rows(one_row: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn one wide row into several narrow ones (metadata-sized result)."""
    packed = F.array(*[F.struct(*[v.alias(k) for k, v in row.items()]) for row in rows])
    return one_row.select(F.inline(packed))
