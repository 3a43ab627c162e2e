"""Packing by non-negative least squares over combinations of lengths.

Documents are cut at window borders, so that every piece but a document's last fills a
window. What is left is a histogram of at most ``window`` piece lengths, whatever the number of
documents. Shallow combinations of lengths that fill a window exactly are enumerated, repeat
counts are fitted to the histogram by non-negative least squares and rounded within what
there is, and the remaining lengths are packed greedily. Pieces are then numbered within
their length and find their place in that plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col
from scoreloom.llm.tokens import Encoder

WINDOW = 1024
#: The id that ends each document.
END = 0
#: Lengths in a combination at most, and sweeps of the least-squares fit.
DEPTH = 3
SWEEPS = 3
#: Combinations of three lengths whose smallest is over this are left to the greedy step.
SHORTEST = 96


def combinations_filling(lengths: list[int], window: int, depth: int = DEPTH, shortest: int = SHORTEST) -> list[tuple]:
    """Ascending combinations of up to ``depth`` (at most 3) of the lengths that sum to the window."""
    have = set(lengths)
    out = [(window,)] if window in have else []
    if depth >= 2:
        out += [(a, window - a) for a in sorted(have) if 2 * a <= window and window - a in have]
    if depth >= 3:
        for a in (x for x in sorted(have) if x <= shortest):
            out += [(a, b, window - a - b) for b in sorted(have)
                    if a <= b <= window - a - b and window - a - b in have]
    return out


def nonnegative_fit(combos: list[tuple], histogram: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts >= 0 that bring the used lengths nearest to the histogram in squares.

    Coordinate descent: each count in turn takes its best value given all others. Shorter
    combinations come first, so most of the longer ones end at zero.
    """
    rest = histogram.astype(float).tolist()
    counts = [0.0] * len(combos)
    uses = [{x: c.count(x) for x in c} for c in combos]
    norms = [sum(n * n for n in u.values()) for u in uses]
    for _ in range(sweeps):
        for i, u in enumerate(uses):
            step = sum(n * rest[x] for x, n in u.items()) / norms[i]
            new = max(0.0, counts[i] + step)
            if new != counts[i]:
                for x, n in u.items():
                    rest[x] -= n * (new - counts[i])
                counts[i] = new
    return np.array(counts)


def greedy_fill(left: dict[int, int], window: int) -> list[tuple[tuple, int]]:
    """Combinations for what is left: the longest piece, then the longest that still fits.

    Each combination repeats as often as its lengths allow, so the steps depend on the number
    of lengths and not on the number of pieces.
    """
    left = {n: c for n, c in left.items() if c > 0}
    order, out = sorted(left), []
    while order:
        combo, room, used = [], window, {}
        limit = len(order)
        while limit:
            limit = bisect_right(order, room, 0, limit)
            if not limit:
                break
            n = order[limit - 1]
            take = min(room // n, left[n])
            combo += [n] * take
            used[n] = take
            room -= n * take
            limit -= 1
        times = min(left[n] // k for n, k in used.items())
        out.append((tuple(combo), times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                order.remove(n)
    return out


def window_plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple, int]]:
    """(lengths, repeats) of sequences that take every piece of the histogram exactly once."""
    left = {n: c for n, c in histogram.items() if c > 0}
    counts = np.zeros(window + 1)
    for n, c in left.items():
        counts[n] = c
    combos = combinations_filling(sorted(left), window)
    fitted = nonnegative_fit(combos, counts)
    plan = []
    for i in np.argsort(-fitted, kind="stable"):
        times = int(fitted[i] + 0.5)
        if not times:
            break
        times = min([times] + [left[n] // combos[i].count(n) for n in combos[i]])
        if times:
            plan.append((combos[i], times))
            for n in combos[i]:
                left[n] -= times
    return plan + greedy_fill(left, window)


def _cutter(window: int, path: str | None):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder, task, seen = Encoder(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.ids(text)
                raw = ids.tobytes() + END.to_bytes(4, "little")
                total = len(ids) + 1
                for start in range(0, total, window):
                    length = min(window, total - start)
                    nth = seen[length] = seen.get(length, -1) + 1
                    rows.append((doc_id, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), total,
                                 task, nth))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"])

    return cut


def _placer(plan: list[tuple[tuple, int]]):
    """A function from (length, rank) to (sequence_id, offset), by a table of the plan's slots."""
    slots, used, sequence = [], {}, 0
    for combo, times in plan:
        offset = 0
        for n in combo:
            first = used.get(n, 0)
            slots.append((n, first, sequence, offset))
            used[n] = first + times
            offset += n
        sequence += times
    length, first, base, offset = np.array(sorted(slots), np.int64).reshape(-1, 4).T
    key = (length << 48) + first

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        ranks = ranks.to_numpy(np.int64)
        at = np.searchsorted(key, (lengths.to_numpy(np.int64) << 48) + ranks, side="right") - 1
        return pd.DataFrame({"sequence_id": base[at] + ranks - first[at], "offset": offset[at]})

    return place


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``window`` tokens.

    A document is the ids of its text and one id 0; a null text counts as empty, so it and an
    empty text are one piece of one token. Repeated rows and rows with a null id are packed
    each by itself. Returns per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``. Sequence numbers have no gaps. An empty table
    gives an empty one; further columns of the input are ignored.

    Only the histogram (at most ``window`` rows) comes to the driver, and the plan sent back
    is bounded by the window too. Pieces get their rank within their length from a count per
    task and length, so no length, however common, is gathered anywhere.
    """
    ids = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    numbers = [StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "task", "nth")]
    pieces = stage(ids.mapInPandas(_cutter(window, tokenizer), StructType([ids.schema["doc_id"], *numbers])), "pieces")
    per_task = stage(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    place = _placer(window_plan(histogram, window))
    return (pieces.join(bases, ["length", "task"])
            .withColumn("place", place("length", F.col("base") + F.col("nth")))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "place.sequence_id", "place.offset"))
