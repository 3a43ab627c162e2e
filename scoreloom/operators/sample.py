"""Seeded sampling and splitting on a row hash.

The hash of the seed and the key columns orders the rows, whatever their
partitioning, so every operator gives the same rows on every run. Share-based
operators are plain filters. Exact sizes need the n smallest hashes: counts per
hash prefix find the prefix in which the n-th row lies (the edge), rows before it
are taken by a filter. While an edge has many rows, only they are counted again,
some digits deeper; the rows of the last, small edge are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import column, hash_int, hash_share, row_hash
from scoreloom.functions.staging import stage

#: Digits that the successive counts look at: 32 of the key's hash, then 32 of the whole row's, which tell
#: rows of one key apart. A count has at most 65,536 prefixes a stratum, as 8 digits leave next to one hash.
LEVELS = (4, 8, 32, 36, 40, 64)
#: Rows of a stratum that one task ranks at most; full copies beyond count as one row.
EDGE_ROWS = 100_000
COPIES_PER_TASK_ROW = 10_000


def split_by_share(df: DataFrame, share: float, keys: Sequence[str],
                   seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Two disjoint frames, each row assigned independently."""
    if not 0 < share < 1:
        raise ValueError("split share lies between 0 and 1")
    first = hash_share(keys, f"split:{seed}") < F.lit(share)
    return df.where(first), df.where(~first)


def holdout(df: DataFrame, keys: Sequence[str], seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """The 70/30 training and validation split."""
    return split_by_share(df, 0.7, keys, seed)


def sample_share(df: DataFrame, share: float, keys: Sequence[str], seed: int = 1) -> DataFrame:
    """Keep each row with the given probability."""
    if not (isinstance(share, float) and 0 < share < 1):
        raise ValueError("sample share is out of range")
    return df.where(hash_share(keys, f"share:{seed}") < F.lit(share))


def modulo_fold(keys: Sequence[str], folds: int, seed: int = 1) -> Column:
    """Fold 0..folds-1 of a row."""
    return F.pmod(hash_int(row_hash(keys, f"fold:{seed}")), F.lit(folds)).cast("int")


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times; a long run of copies is spread over tasks."""
    chunk = F.lit(COPIES_PER_TASK_ROW)
    chunks = F.ceil(times / chunk).cast("bigint")
    spread = (df.withColumn("__times", times.cast("bigint"))
              .withColumn("__chunk", F.explode(F.sequence(F.lit(1).cast("bigint"), chunks))))
    size = F.least(chunk, F.col("__times") - (F.col("__chunk") - 1) * chunk)
    # round-robin on distinct (row, chunk) pairs, then unroll inside the tasks
    return (spread.withColumn("__size", size).repartition(*[column(c) for c in df.columns], "__chunk")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__size"))))
            .select(*[column(c) for c in df.columns]))


def lowest_hashes(df: DataFrame, wanted: Column, keys: Sequence[str], stream: str,
                  strata: Sequence[str] = (), edge_rows: int = EDGE_ROWS) -> tuple[DataFrame, DataFrame]:
    """The ``wanted`` rows of every stratum with the smallest row hashes, and the rest.

    ``wanted`` may use ``stratum_rows``, the number of rows of the stratum. Rows with
    equal hashes are ordered by the whole row, by its hash when they are more than
    ``edge_rows``; full copies are interchangeable.
    """
    names = [column(c) for c in df.columns]
    groups = ["__s%d" % i for i in range(len(strata))] or ["__s0"]
    group_values = [column(s) for s in strata] or [F.lit(0)]
    hashed = df.withColumn("__hash", row_hash(keys, stream)).withColumns(dict(zip(groups, group_values)))

    def edges(rows: DataFrame, digits: int, wanted: Column, carried: Sequence[Column] = ()) -> DataFrame | Row | None:
        """``l<group>, __edge, __left, __rows``: the prefix the last wanted row lies in, one row per stratum.

        Without strata it is a single row, which becomes constants of the filters.
        """
        counts = rows.groupBy(*groups, F.substring("__hash", 1, digits).alias("__prefix")).agg(
            F.count(F.lit(1)).alias("n"), *carried)
        up_to = W.partitionBy(*groups).orderBy("__prefix").rowsBetween(W.unboundedPreceding, W.currentRow)
        found = (counts.withColumn("stop", F.sum("n").over(up_to))
                 .withColumn("stratum_rows", F.sum("n").over(W.partitionBy(*groups)))
                 .withColumn("wanted", wanted.cast("bigint"))
                 .where((F.col("stop") > F.col("wanted")) & (F.col("stop") - F.col("n") <= F.col("wanted")))
                 .select(*[F.col(g).alias("l" + g) for g in groups], F.col("__prefix").alias("__edge"),
                         (F.col("wanted") - (F.col("stop") - F.col("n"))).alias("__left"), F.col("n").alias("__rows")))
        if not strata:
            return found.first()
        # staged, so that its true size decides between a broadcast and a shuffled join
        return stage(found, "limits")

    def marked(rows: DataFrame, limits: DataFrame | Row | None, how: str) -> DataFrame:
        """The rows with the edge of their stratum; a stratum without one is wanted whole."""
        if not strata:
            edge, left = (limits["__edge"], limits["__left"]) if limits else (None, None)
            return rows.withColumns({"__edge": F.lit(edge).cast("string"), "__left": F.lit(left).cast("bigint")})
        same = F.lit(True)
        for g in groups:
            same = same & F.col(g).eqNullSafe(F.col("l" + g))
        return rows.join(limits.drop("__rows"), same, how).drop(*["l" + g for g in groups])

    limits = edges(hashed, LEVELS[0], wanted)
    large = F.col("__rows") > edge_rows
    for digits in LEVELS[1:]:
        if limits is None or (limits.where(large).isEmpty() if strata else limits["__rows"] <= edge_rows):
            break
        if digits > 32 >= digits - 4:
            hashed = hashed.withColumn("__hash", F.concat("__hash", row_hash(df.columns, stream)))
        inside = marked(hashed, limits.where(large) if strata else limits, "inner")
        deeper = edges(inside.where(F.col("__hash").startswith(F.col("__edge"))), digits,
                       F.col("carried"), [F.max("__left").alias("carried")])
        limits = limits.where(~large).unionByName(deeper) if strata else deeper

    rows = marked(hashed, limits, "left")
    at_edge = F.col("__hash").startswith(F.col("__edge"))
    surely = F.col("__edge").isNull() | (F.col("__hash") < F.col("__edge"))

    distinct = rows.where(at_edge).groupBy(*groups, "__hash", "__left", *names).agg(F.count(F.lit(1)).alias("__n"))
    before = (W.partitionBy(*groups).orderBy("__hash", *names)
              .rowsBetween(W.unboundedPreceding, -1))
    room = F.col("__left") - F.coalesce(F.sum("__n").over(before), F.lit(0))
    dealt = distinct.withColumn("__take", F.least(F.col("__n"), F.greatest(room, F.lit(0))))

    def both(whole: Column, copies: Column) -> DataFrame:
        repeated = repeat_rows(dealt.select(*names, copies.alias("__copies")).where("__copies > 0"),
                               F.col("__copies"))
        return rows.where(whole).select(*names).unionByName(repeated.select(*names))

    return (both(surely, F.col("__take")),
            both((F.col("__hash") > F.col("__edge")) & ~at_edge, F.col("__n") - F.col("__take")))


def sample_n(df: DataFrame, rows: int, keys: Sequence[str], seed: int = 1) -> DataFrame:
    """Exactly ``rows`` rows (all of them when the table is smaller)."""
    return lowest_hashes(df, F.lit(rows), keys, f"sample:{seed}")[0]


def stratified_split(df: DataFrame, share: float, stratum: str, keys: Sequence[str],
                     seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """``floor(share * rows)`` of each stratum, and the rest."""
    if not 0 < share < 1:
        raise ValueError("split share lies between 0 and 1")
    quota = F.floor(F.lit(share) * F.col("stratum_rows"))
    return lowest_hashes(df, quota, keys, f"stratified:{seed}", [stratum])


def under_sample(df: DataFrame, label: str, cutoff: float, keys: Sequence[str],
                 seed: int = 1) -> DataFrame:
    """Thin the larger of two classes to ``int(minor * cutoff)`` rows.

    Nothing changes while major/minor is at most ``cutoff``.
    """
    # two rows for a binary label; a third one is already an error
    counts = df.groupBy(column(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).limit(3).collect()
    if len(counts) != 2:
        raise ValueError(f"under-sampling needs exactly two labels, {label} has "
                         f"{'more' if len(counts) > 2 else len(counts)}")
    minor, major = sorted(counts, key=lambda r: r["n"])
    if major["n"] / minor["n"] <= cutoff:
        return df
    size = int(minor["n"] * cutoff)
    is_major = column(label).eqNullSafe(F.lit(major["label"]))
    thinned = lowest_hashes(df.where(is_major), F.lit(size), keys, f"under:{seed}")[0]
    return df.where(~is_major).unionByName(thinned)
