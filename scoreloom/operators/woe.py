"""Bins, weight of evidence, chi-square merging and information value.

Everything after the first aggregate works on the long table ``(variable, bin,
n, pos, neg)``. One unpivot and one map-side-combined group-by build it for all
variables; its size is the number of bins and levels, not of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import (
    chi_square, column, cut_right_closed, merge_limit, p_value_ceiling, p_value_floor,
    sample_deviation, weight_of_evidence)
from scoreloom.functions.ordered import ordered_totals
from scoreloom.functions.reshape import to_long
from scoreloom.functions.staging import stage
from scoreloom.operators.quantile import breaks_by_column, quantile_breaks

# Bins of one in-row fold; a variable with more is walked in slices of so many.
SLICE_BINS = 2_000
# Labels that the name of a merged group joins at most.
FOLD_LIMIT = 2_000


# --------------------------------------------------------------------------
# label
# --------------------------------------------------------------------------

def category_text(df: DataFrame, name: str) -> Column:
    """A value as category text: whole floating numbers lose their ``.0``."""
    value = column(name)
    if dict(df.dtypes)[name] not in ("double", "float"):
        return value.cast("string")
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def positive_level(df: DataFrame, target: str, positive: str | None = None) -> str:
    """The level mapped to 1: the named one, ``1`` of 0/1, else the first in order."""
    # three distinct levels already decide that the label is not binary
    found = sorted(r[0] for r in df.select(category_text(df, target).alias("v"))
                   .where(F.col("v").isNotNull()).distinct().limit(3).collect())
    if len(found) > 2:
        raise ValueError(f"{target} has more than two levels")
    if positive is not None:
        if positive not in found:
            raise ValueError(f"{positive} is no level of {target}")
        return positive
    if set(found) <= {"0", "1"}:
        return "1"
    if len(found) != 2:
        raise ValueError(f"{target} needs two levels, found {found}")
    return found[0]


def label_to_binary(df: DataFrame, target: str, positive: str | None = None,
                    name: str = "y") -> DataFrame:
    """Add the 0/1 label, mapped in one step; a NULL label stays NULL."""
    level = positive_level(df, target, positive)
    text = category_text(df, target)
    return df.withColumn(name, F.when(text.isNotNull(), (text == F.lit(level)).cast("int")))


# --------------------------------------------------------------------------
# bins and counts
# --------------------------------------------------------------------------

def quantile_bins(df: DataFrame, columns: Sequence[str], bins: int = 20,
                  breaks: dict[str, list[float]] | None = None) -> DataFrame:
    """Replace numeric columns by their bin label ``<column>_<i>``."""
    if breaks is None:
        breaks = breaks_by_column(quantile_breaks(df, columns, bins))
    cut = cut_right_closed(df, {c: breaks.get(c, []) for c in columns})
    label = {c: F.concat(F.lit(c + "_"), column("__bin_" + c).cast("string")) for c in columns}
    return cut.select(*[label[c].alias(c) if c in label else column(c) for c in df.columns])


def bin_counts(df: DataFrame, y: str, factors: Sequence[str] = (),
               breaks: dict[str, list[float]] | None = None) -> DataFrame:
    """``(variable, bin, position, n, pos, neg)``; NULL is a bin of its own.

    ``position`` is the bin number of a binned numeric and NULL otherwise.
    """
    breaks = breaks or {}
    used = df.select(column(y).cast("int").alias("__y"), *[column(c) for c in [*breaks, *factors]])
    cut = cut_right_closed(used, breaks)
    codes = {c: column("__bin_" + c).cast("string") for c in breaks}
    codes.update({c: column(c).cast("string") for c in factors})
    numeric = F.col("variable").isin(*breaks) if breaks else F.lit(False)
    code = F.col("code")
    return (to_long(cut, codes, carry=["__y"], value="code")
            .groupBy("variable", "code")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("pos"))
            .select("variable",
                    F.when(numeric & code.isNotNull(), F.concat("variable", F.lit("_"), code))
                    .otherwise(code).alias("bin"),
                    F.when(numeric, code.try_cast("int")).alias("position"),
                    "n", "pos", (F.col("n") - F.col("pos")).alias("neg")))


def with_shares(counts: DataFrame) -> DataFrame:
    """Add ``pct_1`` and ``pct_0``: shares of all positives and all negatives."""
    # read for the rows and for the totals: staged, or the table would be scanned twice
    counts = stage(counts, "counts")
    # one row per variable
    totals = counts.groupBy("variable").agg(F.sum("pos").alias("__pos"), F.sum("neg").alias("__neg"))
    return (counts.join(F.broadcast(totals), "variable")
            .withColumn("pct_1", F.try_divide(F.col("pos"), F.col("__pos")))
            .withColumn("pct_0", F.try_divide(F.col("neg"), F.col("__neg")))
            .drop("__pos", "__neg"))


def woe_table(counts: DataFrame) -> DataFrame:
    """Add shares and weight of evidence to every bin."""
    return with_shares(counts).withColumn(
        "woe", weight_of_evidence(F.col("pct_1"), F.col("pct_0")))


def woe_order(woe: DataFrame) -> DataFrame:
    """Add ``rank`` 1..n by ascending weight of evidence, then level, per variable."""
    order = [F.col("woe").asc_nulls_first(), F.col("bin").asc_nulls_first()]
    return ordered_totals(woe, order, {"rank": F.lit(1).cast("bigint")}, group=["variable"])


# --------------------------------------------------------------------------
# chi-square
# --------------------------------------------------------------------------

def adjacent_chi2(counts: DataFrame) -> DataFrame:
    """Chi-square and p-value bracket of each quantile bin against the one before."""
    # at most one row per break in a variable's window
    bins = counts.where(F.col("position").isNotNull())
    w = W.partitionBy("variable").orderBy("position")
    a, b = F.lag("pos").over(w).cast("double"), F.lag("neg").over(w).cast("double")
    paired = bins.withColumn("a", a).withColumn("b", b).where(F.col("a").isNotNull())
    chi2 = chi_square(F.col("a"), F.col("b"), F.col("pos").cast("double"), F.col("neg").cast("double"))
    return (paired.withColumn("chi2", chi2)
            .select("variable", "position", "bin", "chi2",
                    p_value_floor(F.col("chi2")).alias("p_low"),
                    p_value_ceiling(F.col("chi2")).alias("p_high")))


_OPEN = "struct<pos:double,neg:double,size:bigint>"


def _walk(bins: Column, opened: Column, limit: float) -> Column:
    """Walk ordered bins from an open group (null: none) and return ``(ids, last, pos, neg, size)``.

    ``ids`` has per bin the number of groups begun so far, so 0 while the open group goes on, and the bin's
    place in its group; the rest is the group left open at the end.
    """
    start = F.struct(F.array().cast("array<struct<at:int,member:bigint>>").alias("ids"), F.lit(0).alias("at"),
                     *[F.coalesce(opened[f], F.lit(0).cast(t)).alias(f)
                       for f, t in (("pos", "double"), ("neg", "double"), ("size", "bigint"))])

    def step(state: Column, x: Column) -> Column:
        p, q = x["pos"].cast("double"), x["neg"].cast("double")
        joins = (state["size"] > 0) & (chi_square(state["pos"], state["neg"], p, q) <= F.lit(limit))
        at = F.when(joins, state["at"]).otherwise(state["at"] + 1)
        member = F.when(joins, state["size"]).otherwise(F.lit(0).cast("bigint"))
        return F.struct(
            F.concat(state["ids"], F.array(F.struct(at.alias("at"), member.alias("member")))).alias("ids"), at.alias("at"),
            F.when(joins, state["pos"] + p).otherwise(p).alias("pos"),
            F.when(joins, state["neg"] + q).otherwise(q).alias("neg"), (member + 1).alias("size"))

    return F.aggregate(bins, start, step)


def _sliced(rows: DataFrame, size: int, long: Sequence[str]) -> DataFrame:
    """``(variable, slice, bins)``: the bins in walking order, at most ``size`` of them in a row."""
    entry = F.struct("key", "tie", *[column(c) for c in rows.columns if c not in ("variable", "key", "tie")])
    is_long = F.col("variable").isin(*long)
    placed = rows.withColumn("__slice", F.lit(0).cast("bigint"))
    if long:
        ranked = ordered_totals(rows.where(is_long), [F.col("key"), F.col("tie")], {"__nth": F.lit(1).cast("bigint")}, group=["variable"])
        far = ranked.withColumn("__slice", F.floor((F.col("__nth") - 1) / F.lit(size)).cast("bigint")).drop("__nth")
        placed = placed.where(~is_long).unionByName(far.select(*[column(c) for c in placed.columns]))
    return placed.groupBy("variable", F.col("__slice").alias("slice")).agg(
        F.array_sort(F.collect_list(entry)).alias("bins"),
        F.struct(F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"),
                 F.count(F.lit(1)).alias("size")).alias("total"))


def _walked_groups(rows: DataFrame, limit: float, size: int, long: Sequence[str]) -> DataFrame:
    """Group number and place in the group of every bin, by a left walk over the ordered bins of a variable.

    Each slice is first walked as if a group began with it. Then the group that is open at its begin is
    handed to each slice, and those that were walked from another one are walked again, until nothing
    changes. A walk soon meets a break that the last one had too and then ends alike, so few rounds do. What
    is handed on is what the last slice with a break left open and all bins since, so a group that spans
    any number of slices takes no round for each. All slices of a round run in parallel.
    """
    slices = _sliced(rows, size, long)
    none = F.lit(None).cast(_OPEN)
    if not long:
        walked = slices.withColumn("ids", _walk(F.col("bins"), none, limit)["ids"]).withColumn("before", F.lit(0))
    else:
        slices = stage(slices, "slices")

        def walk(df: DataFrame) -> DataFrame:
            return df.withColumn("__w", _walk(F.col("bins"), F.col("opened"), limit)).select(
                "variable", "slice", "opened", "total", "__w.ids", F.col("__w.at").alias("begun"),
                F.struct(*[F.col("__w")[f].alias(f) for f in ("pos", "neg", "size")]).alias("open"))

        order = W.partitionBy("variable").orderBy("slice")  # one row per slice
        state = stage(walk(slices.withColumn("opened", none)), "walks")
        fields = ("pos", "neg", "size")
        before = order.rowsBetween(W.unboundedPreceding, -1)
        while True:
            summed = state.select("variable", "slice", "opened", "begun", "open", F.struct(
                *[F.sum(F.col("total")[f]).over(order).alias(f) for f in fields]).alias("sums"), "total")
            broken = F.last(F.when(F.col("begun") > 0, F.struct("open", "sums")), ignorenulls=True).over(before)
            handed = summed.withColumn("__b", broken).select("variable", "slice", "opened", F.when(
                F.col("__b").isNotNull(), F.struct(*[(F.col("__b.open")[f] + F.col("sums")[f] - F.col("total")[f]
                                                      - F.col("__b.sums")[f]).alias(f) for f in fields])).alias("now"))
            changed = stage(handed.where(~F.col("now").eqNullSafe(F.col("opened"))).select(
                "variable", "slice", F.col("now").alias("opened")), "changed")
            if changed.isEmpty():
                break
            again = walk(slices.join(changed, ["variable", "slice"]))
            state = stage(state.join(changed, ["variable", "slice"], "left_anti").unionByName(again), "walks")
        earlier = F.sum("begun").over(before)
        begun = state.select("variable", "slice", F.coalesce(earlier, F.lit(0)).cast("int").alias("before"))
        walked = slices.join(state.select("variable", "slice", "ids"), ["variable", "slice"]).join(begun, ["variable", "slice"])
    pairs = F.zip_with("bins", "ids", lambda b, i: F.struct(b.alias("b"), i.alias("i")))
    return walked.select("variable", "before", F.inline(pairs)).select(
        "variable", (F.col("before") + F.col("i.at")).alias("group"), F.col("i.member").alias("member"), "b.*")


def merge_groups(woe: DataFrame, p_threshold: float = 0.1, slice_bins: int = SLICE_BINS) -> DataFrame:
    """Add ``group``: neighbouring bins merge while the chi-square test allows.

    Numerics are walked in bin order, factors in the order of their weight of
    evidence. The missing bin of a numeric keeps to itself as group 0. The
    columns ``key`` and ``tie`` hold the walking order, ``member`` counts within a
    group from 0. A variable with more than ``slice_bins`` bins is walked in slices.
    """
    # one row per variable: which are binned numerics, and which have more bins than one fold
    kinds = woe.groupBy("variable").agg(
        F.max(F.col("position").isNotNull()).alias("numeric"), F.count(F.lit(1)).alias("bins")).collect()
    numeric = F.col("variable").isin(*[k["variable"] for k in kinds if k["numeric"]])
    long = [k["variable"] for k in kinds if k["bins"] > slice_bins]
    rows = woe.select(
        "variable", F.when(numeric, F.col("position").cast("double")).otherwise(F.col("woe")).alias("key"),
        F.when(~numeric, F.col("bin")).alias("tie"),
        *[column(c) for c in woe.columns if c != "variable"])
    apart = numeric & F.col("position").isNull()
    walked = _walked_groups(rows.where(~apart), merge_limit(p_threshold), slice_bins, long)
    return walked.unionByName(rows.where(apart).withColumn("group", F.lit(0))
                              .withColumn("member", F.lit(0).cast("bigint")))


def chi_merge(woe: DataFrame, p_threshold: float = 0.1, fold_limit: int = FOLD_LIMIT) -> DataFrame:
    """``(variable, group, bin, n, pos, neg, pct_1, pct_0, woe)`` after merging.

    ``bin`` joins the member labels in walking order. A group of more than
    ``fold_limit`` members has NULL there; :func:`merged_levels` lists them.
    """
    return _merged_rows(merge_groups(stage(woe, "woe"), p_threshold), fold_limit)


def _merged_rows(groups: DataFrame, fold_limit: int) -> DataFrame:
    label = F.coalesce("bin", F.lit("NULL")).alias("label")
    # at most fold_limit labels per group enter a list
    listed = F.when(F.col("member") < fold_limit, F.struct("key", "tie", "bin", label))
    merged = groups.groupBy("variable", "group").agg(
        *[F.sum(c).alias(c) for c in ("n", "pos", "neg", "pct_1", "pct_0")],
        F.count(F.lit(1)).alias("__members"), F.array_sort(F.collect_list(listed)).alias("__m"))
    joined = (F.when(F.col("__members") == 1, F.col("__m")[0]["bin"])
              .when(F.col("__members") <= fold_limit,
                    F.array_join(F.transform("__m", lambda x: x["label"]), "_")))
    return merged.select("variable", "group", joined.alias("bin"), "n", "pos", "neg", "pct_1", "pct_0",
                         weight_of_evidence(F.col("pct_1"), F.col("pct_0")).alias("woe"))


def merged_levels(groups: DataFrame) -> DataFrame:
    """``(variable, bin, group, woe)``: every bin of :func:`merge_groups`, with the weight of its merged group.

    One row per original bin at every size; no label is joined and none left out.
    """
    groups = stage(groups, "groups")  # read for the rows and for the sums
    sums = groups.groupBy("variable", "group").agg(*[F.sum(c).alias(c) for c in ("pct_1", "pct_0")])
    weight = sums.select("variable", "group", weight_of_evidence(F.col("pct_1"), F.col("pct_0")).alias("woe"))
    return groups.select("variable", "bin", "group").join(weight, ["variable", "group"]).select(
        "variable", "bin", "group", "woe")


def information_value(woe: DataFrame) -> DataFrame:
    """``(variable, iv)``."""
    term = (F.col("pct_1") - F.col("pct_0")) * F.col("woe")
    return woe.groupBy("variable").agg(F.sum(term).alias("iv"))


def woe_values(woe: DataFrame) -> DataFrame:
    """The flat list ``(variable, bin, woe)``."""
    return woe.select("variable", "bin", "woe")


def iv_analysis(df: DataFrame, y: str, numeric: Sequence[str], factors: Sequence[str],
                bins: int = 20, p_threshold: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """The whole chain: breaks, bins, WOE, merging, IV. Returns (iv, merged WOE).

    Missing values are not filled before: they are a bin.
    """
    return _analysed(binned_groups(df, y, numeric, factors, bins, p_threshold))


def iv_and_levels(df: DataFrame, y: str, numeric: Sequence[str], factors: Sequence[str],
                  bins: int = 20, p_threshold: float = 0.1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """:func:`iv_analysis` and :func:`merged_levels` from one walk. Returns (iv, merged WOE, levels)."""
    groups = stage(binned_groups(df, y, numeric, factors, bins, p_threshold), "groups")
    return *_analysed(groups), merged_levels(groups)


def binned_groups(df: DataFrame, y: str, numeric: Sequence[str], factors: Sequence[str],
                  bins: int = 20, p_threshold: float = 0.1) -> DataFrame:
    """Breaks, bins, WOE and the group of every bin."""
    breaks = breaks_by_column(quantile_breaks(df, numeric, bins)) if numeric else {}
    return merge_groups(stage(woe_table(bin_counts(df, y, factors, breaks)), "woe"), p_threshold)


def _analysed(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    merged = stage(_merged_rows(groups, FOLD_LIMIT), "merged")
    return information_value(merged), merged


# --------------------------------------------------------------------------
# level codes
# --------------------------------------------------------------------------

def level_codes(df: DataFrame, y: str, factors: Sequence[str]) -> DataFrame:
    """``(variable, level, woe, code)``: ten times the z-score of the level's WOE.

    The shares are smoothed by 0.01; the code is rounded to a whole number.
    """
    shares = with_shares(bin_counts(df, y, factors))
    smooth = F.lit(0.01)
    woe = shares.select("variable", F.col("bin").alias("level"), F.ln(F.try_divide(
        F.col("pct_1") + smooth, F.col("pct_0") + smooth)).alias("woe"))
    # one row per variable
    scale = woe.groupBy("variable").agg(F.avg("woe").alias("__mean"), sample_deviation(F.col("woe")).alias("__sd"))
    z = F.try_divide(F.col("woe") - F.col("__mean"), F.col("__sd"))
    return (woe.join(F.broadcast(scale), "variable")
            .select("variable", "level", "woe",
                    F.round(z * 10).cast("bigint").cast("string").alias("code")))


def apply_level_codes(df: DataFrame, codes: DataFrame, factors: Sequence[str]) -> DataFrame:
    """Replace levels by their codes; the missing level has a code as well."""
    names = df.columns
    codes = stage(codes, "codes")  # its true size decides between broadcast and shuffle
    for i, c in enumerate(factors):
        m = codes.where(F.col("variable") == c).select(
            F.col("level").alias("__level%d" % i), F.col("code").alias("__code%d" % i))
        df = df.join(m, column(c).cast("string").eqNullSafe(F.col("__level%d" % i)), "left")
        df = df.drop("__level%d" % i)
    coded = {c: F.col("__code%d" % i) for i, c in enumerate(factors)}
    return df.select(*[coded[c].alias(c) if c in coded else column(c) for c in names])


def reduce_levels(df: DataFrame, y: str, factors: Sequence[str], level_numbers: dict[str, int],
                  max_levels: int = 200) -> tuple[DataFrame, DataFrame | None]:
    """Code the factors with more than ``max_levels`` levels; returns (df, codes)."""
    wide = [c for c in factors if level_numbers.get(c, 0) > max_levels]
    if not wide:
        return df, None
    codes = level_codes(df, y, wide)
    return apply_level_codes(df, codes, wide), codes
