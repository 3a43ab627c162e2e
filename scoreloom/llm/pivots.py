"""SimHash near-duplicates: candidates thrown out by a table of distances to pivots.

A fingerprint pair within ``RADIUS`` bits differs by at most ``RADIUS`` in its distance to any
third fingerprint. So the distances of every fingerprint to many pivots are computed once,
pairs whose largest coordinate difference is over the radius are discarded, and only the
survivors are compared bit by bit.

Which pairs meet at all is settled without loss: the 64 bits are cut into ``BLOCKS`` blocks, a
pair within 4 bits leaves at least three of seven blocks untouched, so each fingerprint is
sent to the 35 cells of three blocks. What lies in a cell is joined inside one task, which
gives out links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col, fresh, shuffle_partitions
from scoreloom.llm.components import components

RADIUS = 4
SHINGLE = 4
SEED = 42
BLOCKS = 7
PIVOTS = 32
#: Cells up to this size are compared pair by pair; beyond, star by star.
SMALL_CELL = 32
#: Cells estimated above this size are split over several tasks.
CELL_ROWS = 4096
#: One of so many fingerprints is counted to find such cells. It places work, never results.
COUNTED = 64


def simhash64(text: str | None) -> int:
    """The signed 64-bit fingerprint of a text by the rule of the contract.

    Words are runs without ASCII white space after A-Z are lower-cased; terms are windows of
    four words joined by spaces, repeats included, or all words when there are fewer. A bit
    is set when over half of the XXH64 values (seed 42) have it. No words: zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    first, last = starts[:n].tolist(), ends[size - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = min(n, at + 65536)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first[at:part], last[at:part])),
                             "<u8", part - at)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([simhash64(t) for t in batch], dtype="int64")


def fingerprint(text: Column) -> Column:
    """A text column's fingerprints as signed longs; null counts as the empty text."""
    return _fingerprints(F.coalesce(text.cast("string"), F.lit("")))


def as_hex(value: Column) -> Column:
    """Sixteen lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """Bit masks of ``blocks`` consecutive runs that make up the 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_table(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot."""
    return np.bitwise_count(values[:, None] ^ pivots[None, :])


def reference_pivots(n: int = PIVOTS) -> np.ndarray:
    """Fingerprints that stand for nothing: hashes of 0, 1, 2 and so on."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(n)], np.uint64)


def _verified(a: np.ndarray, b: np.ndarray, ta: np.ndarray, tb: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs (a[i], b[i]) are within the radius: pivot coordinates first, then bits."""
    at = np.arange(len(a))
    for part in (slice(0, 8), slice(8, None)):
        differ = np.abs(ta[at, part].astype(np.int16) - tb[at, part]).max(axis=1, initial=0)
        at = at[differ <= radius]
    return at[np.bitwise_count(a[at] ^ b[at]) <= radius]


def _small_cells(cell: np.ndarray, values: np.ndarray, table: np.ndarray, radius: int):
    """Pairs within cells, by comparing each row with the next, the one after and so on."""
    found = []
    for step in range(1, SMALL_CELL):
        at = np.flatnonzero(cell[step:] == cell[:-step])
        if not len(at):
            break
        keep = at[_verified(values[at], values[at + step], table[at], table[at + step], radius)]
        found.append(np.stack([values[keep], values[keep + step]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.uint64)


def _star_cells(values: np.ndarray, table: np.ndarray, radius: int) -> np.ndarray:
    """Links that join exactly what is connected within one large cell.

    Each fingerprint not yet placed becomes a centre and takes all within the radius. Two
    stars can only touch when their centres are within three radii; such stars are compared
    unless they are connected already, through the pivot table, and one link is kept.
    """
    left, centres, members, links = np.arange(len(values)), [], [], []
    while len(left):
        near = np.bitwise_count(values[left] ^ values[left[0]]) <= radius
        centres.append(left[0])
        members.append(left[near])
        links += [(left[0], x) for x in left[near][1:]]
        left = left[~near]
    over = list(range(len(centres)))

    def top(i):
        while over[i] != i:
            over[i] = over[over[i]]
            i = over[i]
        return i

    heads = values[np.array(centres, np.int64)]
    for i in range(len(centres)):
        for j in i + 1 + np.flatnonzero(np.bitwise_count(heads[i + 1:] ^ heads[i]) <= 3 * radius):
            if top(i) == top(j):
                continue
            small, large = sorted((members[i], members[j]), key=len)
            for x in small:
                hit = _verified(np.full(len(large), values[x]), values[large],
                                np.broadcast_to(table[x], (len(large), table.shape[1])), table[large], radius)
                if len(hit):
                    links.append((x, large[hit[0]]))
                    over[top(j)] = top(i)
                    break
    return values[np.array(links, np.int64).reshape(-1, 2)]


def _linker(radius: int, pivots: np.ndarray):
    """The function that joins the sorted cells of one partition, some batches at a time."""
    def cells_of(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        parts = [frame[c].to_numpy() for c in ("combo", "masked", "a", "b")]
        new = np.ones(len(frame), bool)
        new[1:] = np.any([p[1:] != p[:-1] for p in parts], axis=0)
        return np.cumsum(new), frame["fp"].to_numpy().astype(np.int64).view(np.uint64)

    def joined(cell: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        sizes = np.bincount(cell)[cell]
        cell, values, sizes = cell[sizes > 1], values[sizes > 1], sizes[sizes > 1]
        table = pivot_table(values, pivots)
        small = sizes <= SMALL_CELL
        found = [_small_cells(cell[small], values[small], table[small], radius)]
        for c in np.unique(cell[~small]):
            found.append(_star_cells(values[cell == c], table[cell == c], radius))
        pairs = np.concatenate(found)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0).view(np.int64)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < 50_000:
                continue
            frame = pd.concat(held, ignore_index=True)
            cell, values = cells_of(frame)
            whole = cell < cell[-1]  # the last cell may go on in the next batch
            if whole.any():
                yield joined(cell[whole], values[whole])
            held = [frame[~whole]]
            rows = len(held[0])
        if rows:
            yield joined(*cells_of(pd.concat(held, ignore_index=True)))

    return run


def hamming_links(fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                  pivots: int = PIVOTS) -> DataFrame:
    """Links ``(u, v)`` that connect exactly the distinct fingerprints (column ``fp``) within ``radius``.

    Cells of ``blocks - radius`` equal blocks find every pair. A cell far above
    ``CELL_ROWS`` is dealt to tasks by pairs of its chunks, so no task holds more than two
    chunks; cells to split are estimated from one in ``COUNTED`` fingerprints.
    """
    spark = fingerprints.sparkSession
    masks = block_masks(blocks)
    chosen = [_signed(sum(masks[i] for i in c)) for c in combinations(range(blocks), blocks - radius)]
    combos = F.array(*[F.struct(F.lit(i).alias("combo"), F.lit(m).alias("mask")) for i, m in enumerate(chosen)])
    cells = (fingerprints.select("fp", F.explode(combos).alias("c"))
             .select("fp", F.col("c.combo").alias("combo"), F.col("fp").bitwiseAND(F.col("c.mask")).alias("masked")))
    counted = cells.where(F.pmod(F.xxhash64("fp"), F.lit(COUNTED)) == 0)
    large = stage(counted.groupBy("combo", "masked").agg((F.count(F.lit(1)) * COUNTED).alias("n"))
                  .where(F.col("n") > CELL_ROWS)
                  .select("combo", "masked", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("chunks")), "cells")
    chunks = F.coalesce("chunks", F.lit(1))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), chunks).cast("int")
    dealt = (cells.join(large, ["combo", "masked"], "left")
             .select("fp", "combo", "masked", own.alias("own"),
                     F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
             .select("combo", "masked", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp"))
    sorted_cells = (dealt.repartition(shuffle_partitions(spark), "combo", "masked", "a", "b")
                    .sortWithinPartitions("combo", "masked", "a", "b"))
    return sorted_cells.mapInPandas(_linker(radius, reference_pivots(pivots)), "u long, v long")


def fingerprint_groups(rows: DataFrame, order: list[str]) -> DataFrame:
    """Of each distinct ``fp`` of ``rows`` its group's least row: ``(fp, root, *order)``.

    ``order`` names the columns whose least values (nulls last) stand for the group.
    """
    key = F.struct(*[x for c in order for x in (col(c).isNull().alias("n_" + c), col(c).alias("v_" + c))])
    classes = stage(rows.groupBy("fp").agg(F.min(key).alias("least")), "classes")
    roots = components(hamming_links(classes.select("fp")))
    placed = stage(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                   .select("fp", F.coalesce("root", "fp").alias("root"), "least"), "placed")
    groups = stage(placed.groupBy("root").agg(F.min("least").alias("least")), "groups")
    return stage(placed.select("fp", "root").join(groups, "root")
                 .select("fp", "root", *[F.col("least")["v_" + c].alias(c) for c in order]), "members")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and near-duplicate group of every document.

    Returns one row per input row: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest non-null id reachable over links of at most 4 bits
    (null if a group has none). Null and empty texts and texts without words share fingerprint
    zero and are linked like any other. Repeated rows are each returned. Ties cannot arise.
    An empty table gives an empty one; further columns of the input are ignored.
    """
    rows = stage(docs.select(col(id_col).alias("doc_id"), fingerprint(col(text_col)).alias("fp")), "fingerprints")
    groups = fingerprint_groups(rows, ["doc_id"])
    return (rows.join(groups.select("fp", F.col("doc_id").alias("component_id")), "fp")
            .select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id"))


def keep_first_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id, null ids last.

    All columns are kept. Of rows that share the smallest id one stays. Null, empty and
    wordless texts form one group.
    """
    fp, row = fresh(docs.columns, "__fp"), fresh(docs.columns, "__row")
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id())
                 .withColumn(fp, fingerprint(col(text_col))), "rows")
    groups = fingerprint_groups(kept.select(col(fp).alias("fp"), col(id_col).alias("id"), col(row).alias("row")),
                                ["id", "row"])
    winners = groups.select(F.col("row").alias(row)).distinct()
    return kept.join(winners, row, "left_semi").select(*[col(c) for c in docs.columns])
