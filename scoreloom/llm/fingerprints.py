"""SimHash document fingerprints and block tables, in DataFrame operations alone.

Terms are windows of five lower-cased words; each term's 64-bit hash votes, with the number of
its occurrences as weight, for or against every bit. Texts with fewer words have one term.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col, shuffle_partitions

SHINGLE = 5
BLANKS = r"[\x20\x09-\x0D]+"
#: Terms counted in 16-bit lanes before the lanes are added up; the top lane has a sign bit to spare.
LANE_TERMS = 32_767
LANES = 16
#: Fingerprints with one key of a block table that are compared in one task; more are dealt to several.
KEY_ROWS = 4_096
#: Every how many ids a document's fingerprint is searched among all.
SEARCHED = 50
_LANE_MASK = 0x0001000100010001


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that later expressions read instead of computing it again.

    Catalyst would otherwise inline an array into a lambda and build it for every element.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def _term_hashes(words: Column, size: Column) -> Column:
    """Hashes of all windows of ``SHINGLE`` words; of the one shorter window if there are fewer words."""
    windows = F.transform(F.sequence(F.lit(0), size - SHINGLE),
                          lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    return F.when(size >= SHINGLE, windows).when(size > 0, F.array(F.xxhash64(words))).otherwise(
        F.array().cast("array<bigint>"))


def _lane_counts(terms: Column) -> Column:
    """Votes for each bit: lane k counts the bits k, k + 16, k + 32 and k + 48, 16 bits each."""
    zero = F.struct(*[F.lit(0).cast("long").alias(f"l{k}") for k in range(LANES)])
    mask = F.lit(_LANE_MASK)

    def add(acc, x):
        return F.struct(*[(acc[f"l{k}"] + F.shiftrightunsigned(x, k).bitwiseAND(mask)).alias(f"l{k}")
                          for k in range(LANES)])

    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(terms), F.lit(1)), F.lit(LANE_TERMS)),
                       lambda start: F.aggregate(F.slice(terms, start, LANE_TERMS), zero, add))


def _signs(lanes: Column, size: Column) -> Column:
    """The fingerprint: bits with more votes for than against."""
    bits = []
    for b in range(64):
        lane, shift = f"l{b % LANES}", 16 * (b // LANES)
        votes = F.aggregate(lanes, F.lit(0).cast("long"),
                            lambda acc, r: acc + F.shiftrightunsigned(r[lane], shift).bitwiseAND(F.lit(0xFFFF)))
        bits.append(F.when(votes * 2 > size, F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long"))
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def with_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as a long; null and wordless texts have 0."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BLANKS), lambda w: w != "")
    kept = df.columns
    df = _held(df, "__w", F.transform(words, lambda w: F.xxhash64(w)))
    df = _held(df, "__t", _term_hashes(F.col("__w"), F.size("__w")))
    df = _held(df, "__l", _lane_counts(F.col("__t")))
    return df.withColumn(name, _signs(F.col("__l"), F.size("__t"))).select(*[col(c) for c in kept], name)


def likeness(a: Column, b: Column) -> Column:
    """The cosine that the differing bits of two fingerprints estimate, 0 if it is negative."""
    return F.greatest(F.lit(0.0), F.cos(F.bit_count(a.bitwiseXOR(b)) * F.lit(3.141592653589793 / 64)))


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def with_next(rows: DataFrame, id_name: str, tie: str, cells: int, prepare: Callable[[DataFrame], DataFrame],
              carried: list[str]) -> DataFrame:
    """``prepare(rows)`` with ``next_<c>`` of the row after it in ascending ``id_name``; the first follows the last.

    Ids are cut into cells at approximate quantiles and each cell is sorted by itself. A copy of
    the first row of the next cell closes each cell, so one shuffle does, and no task sees
    more than a few cells. Null ids come last, equal ids are ordered by ``tie``.
    """
    points = [(i + 1) / cells for i in range(cells - 1)]
    cut = rows.agg(F.approx_percentile(F.col(id_name).cast("double"), points, F.lit(10_000)).alias("c")).first()["c"]
    borders = [float("-inf"), *sorted(set(cut or [])), float("inf")]
    if len(borders) == 2:
        borders.insert(1, 0.0)
    cell = Bucketizer(splits=borders, inputCol="__key", outputCol="__cell", handleInvalid="keep")
    rows = cell.transform(rows.withColumn("__key", F.col(id_name).cast("double"))).drop("__key")
    # ids alone give the first of each cell; at most cells + 1 rows
    heads = rows.groupBy("__cell").agg(F.min(id_name).alias("__id"))
    around = W.orderBy("__cell")
    heads = heads.select(F.coalesce(F.lag("__cell").over(around), F.max("__cell").over(W.partitionBy())).alias("__before"),
                         F.col("__cell").alias("__at"), "__id")
    order = [F.col(id_name).asc_nulls_last(), F.col(tie).asc_nulls_last()]
    first = (rows.join(F.broadcast(heads), (F.col("__cell") == F.col("__at")) & F.col(id_name).eqNullSafe(F.col("__id")))
             .withColumn("__n", F.row_number().over(W.partitionBy("__cell").orderBy(*order))).where("__n = 1")
             .withColumn("__cell", F.col("__before")).withColumn("__copy", F.lit(1))
             .drop("__n", "__at", "__id", "__before"))
    in_cell = W.partitionBy("__cell").orderBy("__copy", *order)
    closed = prepare(rows.withColumn("__copy", F.lit(0)).unionByName(first))
    return (closed.select("*", *[F.lead(c).over(in_cell).alias("next_" + c) for c in carried])
            .where("__copy = 0").drop("__copy", "__cell"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they are.

    In the edited text the last half of the code points (rounded down) is replaced by as many of the
    first of the next document. A null text is empty; of an empty text the edited text is empty too.
    Repeated ids are ordered by text, null ids come last. One document is its own next.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``;
    an empty table gives an empty one; further columns are ignored.
    """
    return _edited(docs, id_col, text_col).drop("fp")


def searched_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``edited_fingerprints`` with ``near_count``, from a search among the fingerprints of all documents.

    For ids that ``SEARCHED`` divides it is the number of different fingerprints, its own among them, within
    the radius of ``within_radius``; null for all others.
    """
    rows = stage(_edited(docs, id_col, text_col), "fingerprints")
    asked = F.coalesce(F.col("doc_id").try_cast("bigint") % SEARCHED == 0, F.lit(False))
    near = (within_radius(rows.where(asked).select("fp"), rows.select("fp")).groupBy("query")
            .agg(F.count(F.lit(1)).alias("near_count")))
    found = rows.where(asked).join(near, F.col("fp") == F.col("query")).drop("query")
    others = rows.where(~asked).withColumn("near_count", F.lit(None).cast("bigint"))
    return found.unionByName(others).drop("fp")


def _edited(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", "text", 4 * shuffle_partitions(docs.sparkSession),
                     lambda df: with_fingerprint(df, F.col("text"), "fp"), ["text", "fp"])
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "fp", "next_fp", F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    rows = with_fingerprint(rows, F.col("edited"), "edited_fp")
    return rows.select("doc_id", "fp", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def within_radius(searched: DataFrame, fingerprints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All fingerprints (column ``fp``) within ``radius`` bits of each searched one (``fp``): ``query, found, bits``.

    The block tables: for every choice of ``blocks - radius`` blocks the bits are permuted so that the
    chosen come first, which is what a mask and equality express; a pair within the radius has at
    least one choice in common, and is given out by the first. Both sides are made distinct first; null
    fingerprints find nothing. Where more than ``KEY_ROWS`` fingerprints share a key they are dealt to slices
    and the searched ones meet each slice, so no task compares a whole cloud.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    runs = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    chosen = [signed(sum(runs[i] for i in c)) for c in combinations(range(blocks), blocks - radius)]
    tables = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(m).alias("mask")) for i, m in enumerate(chosen)])

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return (df.where("fp is not null").select(F.col("fp").alias(name)).distinct()
                .select(name, F.explode(tables).alias("t"))
                .select(name, F.col("t.n").alias("table"), F.col(name).bitwiseAND(F.col("t.mask")).alias("key")))

    queries, stored = keyed(searched, "query"), stage(keyed(fingerprints, "found"), "keyed")
    # at most one row for KEY_ROWS rows of a table
    hot = stage(stored.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > KEY_ROWS)
                .select("table", "key", F.ceil(F.col("n") / KEY_ROWS).cast("int").alias("slices")), "hot")
    slices = F.coalesce("slices", F.lit(1))
    stored = stored.join(hot, ["table", "key"], "left").select(
        "found", "table", "key", F.pmod(F.xxhash64("found"), slices).cast("int").alias("slice"))
    queries = queries.join(hot, ["table", "key"], "left").select(
        "query", "table", "key", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    difference = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(difference.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(chosen)])
    return (queries.join(stored, ["table", "key", "slice"])
            .where((F.bit_count(difference) <= radius) & (first == F.col("table")))
            .select("query", "found", F.bit_count(difference).alias("bits")))
