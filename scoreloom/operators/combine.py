"""Joins and row union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.columns import column


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
          right_keys: Sequence[str] | None = None, left_all: bool = True,
          right_all: bool = True) -> DataFrame:
    """Equi-join: inner, left, right or full by the two flags.

    The columns are the left ones and then the right ones without their keys;
    the left key columns carry the key of rows that only the right side has.

    The matching part is always an inner join, whose skewed partitions adaptive
    execution can split on either side. Rows without a partner come from anti
    joins against the distinct keys of the other side. An outer join could not
    be split on its inner side, and a full one not at all.
    """
    right_keys = list(right_keys or left_keys)
    left_keys = list(left_keys)
    if len(left_keys) != len(right_keys):
        raise ValueError(f"{len(left_keys)} left keys cannot pair with {len(right_keys)} right keys")
    if not left_keys:
        raise ValueError("a join needs keys")
    values = [c for c in right.columns if c not in right_keys]
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")

    keyed = right.select(*[column(k).alias("__k%d" % i) for i, k in enumerate(right_keys)],
                         *[column(v) for v in values])
    right_only_keys = ["__k%d" % i for i in range(len(right_keys))]
    names = left.columns + values
    out = left.join(keyed, _pairs(left, left_keys, keyed, right_only_keys), "inner").select(*[column(n) for n in names])
    if left_all:
        partners = keyed.select(*right_only_keys).distinct()
        alone = left.join(partners, _pairs(left, left_keys, partners, right_only_keys), "left_anti")
        kinds = dict(keyed.dtypes)
        out = out.unionByName(alone.select(
            *[column(c) for c in left.columns],
            *[F.lit(None).cast(kinds[v]).alias(v) for v in values]))
    if right_all:
        partners = left.select(*[column(k) for k in left_keys]).distinct()
        alone = keyed.join(partners, _pairs(partners, left_keys, keyed, right_only_keys), "left_anti")
        kinds = dict(left.dtypes)
        carried = dict(zip(left_keys, right_only_keys))
        out = out.unionByName(alone.select(
            *[column(carried[c]).cast(kinds[c]).alias(c) if c in carried
              else F.lit(None).cast(kinds[c]).alias(c) for c in left.columns],
            *[column(v) for v in values]))
    return out


def _pairs(a: DataFrame, a_keys: Sequence[str], b: DataFrame, b_keys: Sequence[str]):
    cond = None
    for x, y in zip(a_keys, b_keys):
        term = a[quoted(x)] == b[quoted(y)]
        cond = term if cond is None else cond & term
    return cond


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by all other columns.

    A minimum over structs collapses on the map side, so a key with very many
    rows sends one row per task into the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = list(order) + [c for c in rest if c not in order]
    if not ranked:
        return df.distinct()
    best = df.groupBy(*[column(k) for k in keys]).agg(
        F.min(F.struct(*[column(c) for c in ranked])).alias("__best"))
    return best.select(*[column(k) for k in keys],
                       *[F.col("__best").getField(c).alias(c) for c in rest]).select(
        *[column(c) for c in df.columns])


def lookup(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
           right_keys: Sequence[str] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Left join with at most one match per left row: the row count stays."""
    right_keys = list(right_keys or left_keys)
    unique = one_per_key(right, right_keys, order)
    values = [c for c in right.columns if c not in right_keys]
    keyed = unique.select(*[column(k).alias("__k%d" % i) for i, k in enumerate(right_keys)],
                          *[column(v) for v in values])
    cond = _pairs(left, list(left_keys), keyed, ["__k%d" % i for i in range(len(right_keys))])
    # the right side is unique per key, so only left partitions can be skewed,
    # and those adaptive execution splits in a left join
    return left.join(keyed, cond, "left").select(*[column(c) for c in left.columns + values])


def union_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Append rows by column name; absent columns are NULL, numbers widen."""
    return first.unionByName(second, allowMissingColumns=True)
