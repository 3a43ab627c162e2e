"""Exact interpolated quantiles of many columns without sorting the table.

Selection by counting. Splitters from a row sample cut each column into cells;
one pass counts the rows per cell, so the cell of every wanted rank is known
exactly. Cells that are still large are cut again by a sample of their own rows.
Last, the distinct values of the few cells that hold a wanted rank are counted
and ranked, cell by cell. The sample only decides how much work is left, never
the result. Each splitter is also a cell of its own, so a value that very many
rows share is settled by the counts alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import INF, column
from scoreloom.functions.reshape import to_long

SPLITTERS = 128
SAMPLE_ROWS = 50_000
CELL_ROWS = 20_000_000


@dataclass
class _Cell:
    number: int
    rows: int
    low: float
    high: float
    start: int
    ranks: list[int]


def _cuts(points: Sequence[float]) -> list[float]:
    """Every point opens a cell, and the next larger double closes it."""
    out = set()
    for p in points:
        if p is not None and math.isfinite(p):
            out |= {-0.0 if p == 0 else p, math.nextafter(p, INF)}
    return sorted(out)


def _long_cells(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """``(variable, cell, x)`` of the present values."""
    structs = {}
    for i, (c, points) in enumerate(cuts.items()):
        cell = "__cell%d" % i
        if points:
            df = Bucketizer(splits=[-INF, *points, INF], inputCol=c, outputCol=cell,
                            handleInvalid="keep").transform(df)
        else:
            df = df.withColumn(cell, F.lit(0.0))
        structs[c] = F.when(column(c).isNotNull(), F.struct(
            F.col(cell).cast("int").alias("cell"), column(c).alias("x")))
    return (to_long(df, structs).where(F.col("value").isNotNull())
            .select("variable", "value.cell", "value.x"))


def _splitters(long: DataFrame, keys: Sequence[str]) -> dict[tuple, list[float]]:
    grid = [i / SPLITTERS for i in range(SPLITTERS + 1)]
    # a fixed number of values per column and cell
    rows = long.groupBy(*keys).agg(F.percentile_approx("x", grid, 1_000).alias("points")).collect()
    return {tuple(r[k] for k in keys): list(r["points"]) for r in rows}


def _count(long: DataFrame) -> dict[str, list[_Cell]]:
    # at most 2 * SPLITTERS + 3 cells per column and refined cell
    rows = (long.groupBy("variable", "cell")
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
            .orderBy("variable", "cell").collect())
    out: dict[str, list[_Cell]] = {}
    for r in rows:
        cells = out.setdefault(r["variable"], [])
        start = cells[-1].start + cells[-1].rows if cells else 0
        cells.append(_Cell(r["cell"], r["n"], r["low"], r["high"], start, []))
    return out


def _place(cells: list[_Cell], ranks: Sequence[int], known: dict[int, float]) -> list[_Cell]:
    """Settle the ranks the counts decide; return the cells that hold the others."""
    for rank in ranks:
        cell = next(c for c in cells if c.start <= rank < c.start + c.rows)
        if cell.low == cell.high or rank == cell.start:
            known[rank] = cell.low
        elif rank == cell.start + cell.rows - 1:
            known[rank] = cell.high
        else:
            cell.ranks.append(rank)
    return [c for c in cells if c.ranks]


def _marked(long: DataFrame, cells: dict[str, list[_Cell]]) -> DataFrame:
    """Only the rows of the given cells."""
    wanted = None
    for variable, some in cells.items():
        term = (F.col("variable") == variable) & F.col("cell").isin([c.number for c in some])
        wanted = term if wanted is None else wanted | term
    return long.where(wanted)


def _rank_values(long: DataFrame, open_cells: dict[str, list[_Cell]]) -> dict[tuple, float]:
    """Values at the ranks inside cells of bounded size."""
    spark = long.sparkSession
    facts = spark.createDataFrame(
        [(v, c.number, c.start, c.ranks) for v, cells in open_cells.items() for c in cells],
        "v string, k int, first bigint, ranks array<bigint>")
    values = _marked(long, open_cells).groupBy("variable", "cell", "x").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("variable", "cell").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)
    stop = F.col("first") + F.sum("n").over(w)
    # at most two ranks per column and wanted quantile
    placed = (values.join(F.broadcast(facts), (F.col("variable") == F.col("v")) & (F.col("cell") == F.col("k")))
              .withColumn("stop", stop)
              .select("variable", "x", F.explode(F.filter(
                  "ranks", lambda r: (r < F.col("stop")) & (r >= F.col("stop") - F.col("n")))).alias("rank")))
    return {(r["variable"], r["rank"]): r["x"] for r in placed.collect()}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(variable, probability, value)``, linear interpolation, NULL and NaN skipped.

    Cells of more than ``cell_rows`` rows are cut again until none that holds a wanted rank is left.
    """
    probs = sorted(set(probs))
    # adding 0.0 makes -0.0 and 0.0 the same bits
    doubles = {c: column(c).cast("double") + F.lit(0.0) for c in columns}
    wide = df.select(*[F.when(~F.isnan(x), x).alias(c) for c, x in doubles.items()])
    rows = wide.count()
    part = wide if rows <= SAMPLE_ROWS else wide.sample(SAMPLE_ROWS / rows, seed=1)
    first = _splitters(_long_cells(part, {c: [] for c in columns}), ["variable"])
    cuts = {c: _cuts(first.get((c,), [])) for c in columns}

    ranks: dict[str, list[int]] = {}
    totals: dict[str, int] = {}
    known: dict[str, dict[int, float]] = {}
    while True:
        long = _long_cells(wide, cuts)
        counted = _count(long)
        open_cells: dict[str, list[_Cell]] = {}
        for v, cells in counted.items():
            if v not in totals:
                totals[v] = cells[-1].start + cells[-1].rows
                below = {math.floor(p * (totals[v] - 1)) for p in probs}
                ranks[v] = sorted(below | {min(b + 1, totals[v] - 1) for b in below})
                known[v] = {}
            left = _place(cells, [r for r in ranks[v] if r not in known[v]], known[v])
            if left:
                open_cells[v] = left
        large = {v: [c for c in cells if c.rows > cell_rows] for v, cells in open_cells.items()}
        large = {v: cells for v, cells in large.items() if cells}
        if not large:
            break
        sizes = [c.rows for cells in large.values() for c in cells]
        share = min(1.0, SAMPLE_ROWS * len(sizes) / sum(sizes))
        again = _marked(long, large)
        finer = _splitters(again if share >= 1 else again.sample(share, seed=1), ["variable", "cell"])
        # the least and the largest value of a cell get cells of their own, so every round cuts off values
        cuts = {v: _cuts([x for c in cells for x in (c.low, c.high, *finer.get((v, c.number), []))])
                for v, cells in open_cells.items()}
        wide = wide.select(*[column(v) for v in open_cells])
    if open_cells:
        narrow = wide.select(*[column(v) for v in open_cells])
        long = _long_cells(narrow, {v: cuts[v] for v in open_cells})
        for (v, rank), x in _rank_values(long, open_cells).items():
            known[v][rank] = x

    out = []
    for v in ranks:
        for p in probs:
            at = p * (totals[v] - 1)
            k = math.floor(at)
            low, high = known[v][k], known[v][min(k + 1, totals[v] - 1)]
            out.append((v, p, low + (high - low) * (at - k)))
    # as many rows as columns times quantiles
    return df.sparkSession.createDataFrame(out, "variable string, probability double, value double")


def quantile_breaks(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """``(variable, position, break)`` for probabilities i/bins, i = 0..bins."""
    probs = [i * 1.0 / bins for i in range(bins + 1)]
    return exact_quantiles(df, columns, probs).select(
        "variable", F.round(F.col("probability") * bins).cast("int").alias("position"),
        F.col("value").alias("break"))


def breaks_by_column(breaks: DataFrame) -> dict[str, list[float]]:
    """Bring the breaks to the driver: (bins + 1) numbers per column."""
    out: dict[str, list[float]] = {}
    for r in breaks.orderBy("variable", "position").collect():
        out.setdefault(r["variable"], []).append(r["break"])
    return out


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return exact_quantiles(df, columns, [0.5]).select("variable", F.col("value").alias("median"))
