"""Temperature mixing of sources, in DataFrame operations alone.

Source shares p become weights in proportion to p ** exponent. The exponent is found by
bisection, so that the weights meet a target entropy or so that no source repeats more often than
a limit. The weights are realised as blocks: every source runs through whole random permutations
of its documents, and the last, partial permutation stops at the source's token budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col, fresh

#: Exponents are multiples of one over this.
STEPS = 1_000_000
REPETITION_LIMIT = 2.0
ENTROPY_SHARE = 0.999
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of a permutation hash by which token sums are gathered before rows are looked at.
PREFIXES = (3, 6)


def words(text: Column) -> Column:
    """Words of a text, white space being ASCII's; none for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(block: Column, doc_id: Column) -> Column:
    """The place of a document in a block's permutation: hex digits to sort by."""
    return F.md5(F.concat_ws("|", F.lit(SEED), block.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _curve(shares: DataFrame, steps: list[int]) -> list:
    """(step, entropy, repetitions of the rarest source against the largest's) at some exponents."""
    grid = shares.select("p", "top", F.explode(F.array(*[F.lit(k) for k in steps])).alias("k"))
    e = F.col("k") / F.lit(float(STEPS))
    power = F.pow("p", e)
    return sorted(grid.groupBy("k").agg(
        F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("s"),
        F.max(F.pow(F.col("p") / F.col("top"), e - 1)).alias("repeats")).select(
        "k", (F.log("z") - F.col("k") / F.lit(float(STEPS)) * F.col("s") / F.col("z")).alias("entropy"), "repeats").collect())


def _least(shares: DataFrame, good, ways: int = 32) -> int:
    """The least step for which ``good(entropy, repeats)`` holds from there on; ``STEPS`` if for none.

    A bisection that looks at ``ways`` places a round: the driver gets one row for each.
    """
    low, high = -1, STEPS
    while high - low > 1:
        steps = sorted({low + max(1, (high - low) * i // ways) for i in range(1, ways)} - {high})
        for k, entropy, repeats in _curve(shares, [s for s in steps if low < s < high]):
            if good(entropy, repeats):
                high = min(high, k)
            else:
                low = max(low, k)
    return high


def exponent(shares: DataFrame, repetition_limit: float | None = REPETITION_LIMIT,
             entropy_share: float | None = ENTROPY_SHARE) -> float:
    """The exponent for ``shares (p, top)``, ``top`` being the largest share.

    Weights are flattened until their entropy reaches ``entropy_share`` of that of equal
    weights, and no further than the repetition limit allows.
    """
    n = shares.count()
    if n < 2:
        return 1.0
    k = 0
    if entropy_share is not None:
        target = entropy_share * F.log(F.lit(float(n)))
        target = shares.select(target.alias("t")).first()["t"]
        k = max(k, _least(shares, lambda entropy, repeats: entropy < target) - 1)
        if _curve(shares, [STEPS])[0][1] >= target:
            k = STEPS
    if repetition_limit is not None:
        k = max(k, _least(shares, lambda entropy, repeats: repeats <= repetition_limit))
    return max(k, 0) / STEPS


def _cut(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the last permutation hash within its budget, ``(source, last)``.

    ``rows`` has source, tokens and h. Token sums per hash prefix show the prefix in which the
    budget ends; only rows of that prefix are looked at more closely, and rows one by
    one only within a prefix that holds one row in 16 million. Rows with one hash go together.
    """
    open_, done, previous = budgets, None, None
    for digits in (*PREFIXES, None):
        near = rows if previous is None else rows.withColumn("cell", F.substring("h", 1, previous)).join(
            open_.select(F.col("source").alias("s"), F.col("cell").alias("c")),
            F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")), "left_semi")
        key = F.col("h") if digits is None else F.substring("h", 1, digits)
        sums = near.groupBy("source", key.alias("cell")).agg(F.sum("tokens").alias("t"))
        totals = sums.select(F.col("source").alias("s"), F.col("cell").alias("at"), "t",
                             F.sum("t").over(W.partitionBy("source").orderBy("cell")).alias("run"))
        limits = open_.select("source", "budget")
        met = totals.join(limits, F.col("s").eqNullSafe(F.col("source")))
        if digits is None:
            inside = stage(met.where("run <= budget").groupBy("source").agg(F.max("at").alias("last")), "last")
            left = open_.join(inside.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
            ends = left.select("source", F.coalesce("last", "cell").alias("last"))
            done = ends if done is None else done.unionByName(ends)
        else:
            crossing = met.where("run > budget").groupBy("source").agg(
                F.min(F.struct("at", "run", "t")).alias("first"))
            next_ = stage(crossing.join(limits.withColumnRenamed("source", "s"),
                                        F.col("source").eqNullSafe(F.col("s")))
                          .select("source", F.col("first.at").alias("cell"),
                                  (F.col("budget") - F.col("first.run") + F.col("first.t")).alias("budget")), "cut")
            open_, previous = next_, digits
    return done


def mixing_plan(rows: DataFrame, repetition_limit: float | None = REPETITION_LIMIT,
                entropy_share: float | None = ENTROPY_SHARE) -> DataFrame:
    """``(source, blocks, last)``: whole permutations of each source and where its partial one ends.

    ``rows`` has source, tokens, doc_id. The largest source runs through once, any other
    ``(p / largest p) ** (exponent - 1)`` times, so no document is lost and the weights are in
    proportion to p ** exponent. A source without tokens runs through once.
    """
    stats = stage(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    all_, top = stats.agg(F.sum("tokens"), F.max("tokens")).first()
    shares = stats.where("tokens > 0").select((F.col("tokens") / F.lit(float(all_ or 1))).alias("p"),
                                              F.lit((top or 0) / float(all_ or 1)).alias("top"))
    power = exponent(shares, repetition_limit, entropy_share)
    runs = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(top or 1)), F.lit(power - 1.0))
                  ).otherwise(F.lit(1.0))
    plan = stage(stats.select("source", "tokens", F.floor(F.col("tokens") * runs).alias("goal"),
                              F.floor(runs).cast("int").alias("blocks"))
                 .withColumn("budget", F.col("goal") - F.col("blocks") * F.col("tokens")), "plan")
    partial = rows.join(F.broadcast(plan.select(F.col("source").alias("s"), "blocks"))
                        if plan.count() <= 10_000 else plan.select(F.col("source").alias("s"), "blocks"),
                        F.col("source").eqNullSafe(F.col("s")))
    hashed = stage(partial.select("source", "tokens", order_hash(F.col("blocks"), F.col("doc_id")).alias("h")), "hashes")
    ends = _cut(hashed, plan.where("budget > 0").select("source", "budget"))
    return stage(plan.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
                 .select("source", "blocks", "last"), "mixing")


def mix(docs: DataFrame, repetition_limit: float | None = REPETITION_LIMIT,
        entropy_share: float | None = ENTROPY_SHARE, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block_col: str | None = None, hash_col: str | None = None) -> DataFrame:
    """``docs`` once per block that draws them, all columns kept.

    ``block_col`` and ``hash_col`` name two columns to add: the block's number and the place in its
    permutation; sorted by both, the rows are in training order. A null source is a source of its
    own; null and empty texts have no tokens: they are drawn in every whole block, and in the partial
    one if their hash is not after its end. Rows with one id (repeated rows, null ids) share their
    place. An empty table gives an empty one.
    """
    rows = stage(docs.select(col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"),
                             words(col(text_col)).alias("tokens")), "tokens")
    plan = mixing_plan(rows, repetition_limit, entropy_share)
    names = [fresh(docs.columns, n) for n in ("__source", "__blocks", "__last", "__block")]
    small = plan.select(*[col(n).alias(new) for n, new in zip(("source", "blocks", "last"), names)])
    source, blocks, last, block = names
    drawn = docs.join(small, col(source_col).cast("string").eqNullSafe(col(source)))
    partial = F.coalesce(order_hash(col(blocks), col(id_col)) <= col(last), F.lit(False))
    drawn = drawn.withColumn(block, F.explode(F.sequence(F.lit(0), col(blocks) - 1 + partial.cast("int"))))
    added = []
    if block_col:
        added.append(col(block).alias(block_col))
    if hash_col:
        added.append(order_hash(col(block), col(id_col)).alias(hash_col))
    return drawn.select(*[col(c) for c in docs.columns], *added)
