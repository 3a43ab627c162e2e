import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from scoreloom.functions.columns import (
    CHI_SQUARE_CRITICAL, chi_square, cut_right_closed, grid_step, hundredth_bin, merge_limit,
    p_value_ceiling, p_value_floor)
from scoreloom.operators import quantile, woe


def chi_rule(a, b, c, d):
    """Chi-square of two rows by their margins and expected counts, written apart from the library."""
    table = np.array([[a, b], [c, d]], float)
    empty = int((table == 0).sum())
    rows, columns, n = table.sum(axis=1), table.sum(axis=0), table.sum()
    if empty == 4 or (empty == 2 and rows.min() > 0 and columns.min() == 0):
        return 0.0  # nothing there, or both rows on one side alone
    if empty:
        return 100.0
    away = abs(np.linalg.det(table)) - (n / 2 if table.min() < 5 else 0.0)
    return (away ** 2 * n + 0.1) / (rows.prod() * columns.prod() + 0.1)


CHI_CASES = [(0, 3, 4, 5), (3, 0, 4, 5), (3, 4, 0, 5), (3, 4, 5, 0), (3, 0, 5, 0), (0, 3, 0, 5),
             (0, 3, 4, 0), (3, 0, 0, 4), (0, 0, 3, 4), (3, 4, 0, 0), (0, 0, 0, 7), (7, 0, 0, 0),
             (0, 0, 0, 0), (1, 2, 3, 4), (40, 2, 30, 60), (50, 60, 70, 80), (10, 90, 30, 70)]


def test_chi_square_cases(spark):
    df = spark.createDataFrame([tuple(map(float, c)) for c in CHI_CASES], "a double, b double, c double, d double")
    got = df.select("a", "b", "c", "d", chi_square(*[F.col(x) for x in "abcd"]).alias("x")).collect()
    for r in got:
        cells = (r.a, r.b, r.c, r.d)
        assert r.x == pytest.approx(chi_rule(*cells), rel=1e-12), cells


def test_p_value_bracket(spark):
    values = [0.0, 1e-6, 0.0000393, 0.0005, 1.0, 1.642, 2.0, 2.706, 3.0, 5.2, 10.828, 11.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.x: (r.lo, r.hi) for r in df.select(
        "x", p_value_floor(F.col("x")).alias("lo"), p_value_ceiling(F.col("x")).alias("hi")).collect()}
    for v in values:
        low, high = 0.0, 1.0
        for alpha, critical in sorted(CHI_SQUARE_CRITICAL):
            if v > critical:
                high = alpha
                break
            low = alpha
            if v == critical:
                high = alpha
                break
        assert got[v] == (low, high), v
    assert merge_limit(0.1) == 2.706
    assert merge_limit(0.15) == 1.642


def test_cut_edges_and_repeated_breaks(spark):
    df = spark.createDataFrame([(v,) for v in [None, -1.0, 0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 3.5]], "x double")
    got = {r.x: r["__bin_x"] for r in cut_right_closed(df, {"x": [0.0, 1.0, 1.0, 2.0, 3.0]}).collect()}
    assert got == {None: None, -1.0: None, 0.0: 1, 0.5: 1, 1.0: 1, 1.5: 3, 2.0: 3, 3.0: 4, 3.5: None}
    one = cut_right_closed(df, {"x": [2.0, 2.0, 2.0]}).where("x = 2.0").first()
    assert one["__bin_x"] == 1
    negative = spark.createDataFrame([(v,) for v in [-3.0, -2.0, -1.0, -0.0, 0.0, 1.0]], "x double")
    bins = [r["__bin_x"] for r in cut_right_closed(negative, {"x": [-3.0, -1.0, 0.0, 1.0]}).collect()]
    assert bins == [1, 1, 1, 2, 2, 3]


@pytest.mark.parametrize("cell_rows,splitters,sample_rows", [(1_000_000, 256, 200_000), (3, 4, 50), (40, 8, 300)])
def test_quantiles_equal_a_sort(spark, monkeypatch, cell_rows, splitters, sample_rows):
    monkeypatch.setattr(quantile, "SPLITTERS", splitters)
    monkeypatch.setattr(quantile, "SAMPLE_ROWS", sample_rows)
    rng = random.Random(5)
    hot = [7.0] * 700
    values = {"a": [rng.random() for _ in range(2000)], "b": hot + [rng.gauss(0, 9) for _ in range(1300)],
              "c": [float(rng.randrange(5)) for _ in range(2000)], "d": [1.0, 2.0, 4.0] + [None] * 1997,
              "e": [None] * 2000}
    df = spark.createDataFrame(list(zip(*values.values())),
                               "a double, b double, c double, d double, e double").repartition(7)
    probs = [i / 20 for i in range(21)]
    got = {}
    for r in quantile.exact_quantiles(df, list(values), probs, cell_rows).collect():
        got[r.variable, r.probability] = r.value
    for name, column in values.items():
        present = [v for v in column if v is not None]
        for p in probs:
            if not present:
                assert (name, p) not in got
            else:
                assert got[name, p] == pytest.approx(np.quantile(present, p), abs=1e-9), (name, p)


def test_label_mapping(spark):
    def mapped(values, schema="v string", positive=None):
        df = spark.createDataFrame([(v,) for v in values], schema)
        return dict(rows(woe.label_to_binary(df, "v", positive), "v", "y"))
    assert mapped(["-1", "1", None]) == {"-1": 1, "1": 0, None: None}
    assert mapped(["a", "b"]) == {"a": 1, "b": 0}
    assert mapped(["0", "1"]) == {"0": 0, "1": 1}
    assert mapped([0.0, 1.0], "v double") == {0.0: 0, 1.0: 1}
    assert mapped(["a", "b"], positive="b") == {"a": 0, "b": 1}
    with pytest.raises(ValueError):
        mapped(["a", "b", "c"])


def test_woe_missing_bin_and_smoothing(spark):
    data = [("p", 1)] * 3 + [("q", 0)] * 4 + [(None, 1), (None, 0), ("r", 1), ("r", 0), ("r", 0)]
    df = spark.createDataFrame(data, "f string, y int")
    got = {r.bin: r for r in woe.woe_table(woe.bin_counts(df, "y", ["f"])).collect()}
    assert got["p"].pct_1 == pytest.approx(3 / 5) and got["p"].pct_0 == 0
    e = (3 / 5) / 200
    assert got["p"].woe == pytest.approx(math.log((3 / 5 + e) / e))
    assert got[None].n == 2 and got[None].woe == pytest.approx(math.log((1 / 5) / (1 / 7)))
    one_sided = spark.createDataFrame([("p", 1), ("q", 1)], "f string, y int")
    assert all(r.woe is None for r in woe.woe_table(woe.bin_counts(one_sided, "y", ["f"])).collect())


def replay_merge(bins):
    """Plain left-to-right walk over (label, pos, neg)."""
    groups = [[bins[0]]]
    p, n = bins[0][1:]
    for label, q, m in bins[1:]:
        if chi_rule(p, n, q, m) <= 2.706:
            groups[-1].append((label, q, m))
            p, n = p + q, n + m
        else:
            groups.append([(label, q, m)])
            p, n = q, m
    return [("_".join(b[0] for b in g), sum(b[1] for b in g), sum(b[2] for b in g)) for g in groups]


@pytest.mark.parametrize("fold_limit", [2_000, 3])
def test_chi_merge_replay(spark, fold_limit):
    rng = random.Random(11)
    table, expected = [], {}
    for v in range(4):
        bins = [(f"v{v}_{i + 1}", rng.choice([0, 2, 9, 30, 80]), rng.choice([0, 3, 12, 40])) for i in range(20)]
        bins = [b for b in bins if b[1] + b[2]]
        table += [(f"v{v}", b[0], i + 1, b[1] + b[2], b[1], b[2]) for i, b in enumerate(bins)]
        expected[f"v{v}"] = replay_merge(bins)
    df = spark.createDataFrame(table, "variable string, bin string, position int, n long, pos long, neg long")
    got = {}
    for r in woe.chi_merge(woe.woe_table(df), fold_limit=fold_limit).orderBy("variable", "group").collect():
        got.setdefault(r.variable, []).append((r.bin, r.pos, r.neg))
    for v, groups in expected.items():
        if fold_limit == 3:  # long labels are left out, the groups stay
            groups = [(b if b.count("_v") < 3 else None, p, n) for b, p, n in groups]
        assert got[v] == groups


@pytest.mark.parametrize("fold_limit", [2_000, 3])
def test_every_level_of_a_merged_group_is_listed(spark, fold_limit):
    rows = [("f", f"l{i:04d}", None, 4, 2, 2) for i in range(2_500)] + [("f", None, None, 4000, 4000, 0)]
    table = woe.woe_table(spark.createDataFrame(rows, "variable string, bin string, position int, n long, pos long, neg long"))
    merged = {r.group: r for r in woe.chi_merge(table, fold_limit=fold_limit).collect()}
    got = woe.merged_levels(woe.merge_groups(table, slice_bins=500)).collect()
    assert sorted(str(r.bin) for r in got) == sorted(str(r[1]) for r in rows)
    large = [r for r in got if r.bin is not None]
    assert len({r.group for r in large}) == 1 and merged[large[0].group].bin is None
    assert all(r.woe == pytest.approx(merged[r.group].woe) for r in got)


def test_order_and_codes_include_missing(spark):
    data = [("a", 1)] * 5 + [("a", 0)] + [("b", 0)] * 5 + [("b", 1)] + [(None, 1), (None, 0)] * 2
    df = spark.createDataFrame([(i, f, y) for i, (f, y) in enumerate(data)], "id int, f string, y int")
    order = woe.woe_order(woe.woe_table(woe.bin_counts(df, "y", ["f"])))
    assert [(r.bin, r["rank"]) for r in order.orderBy("rank").collect()] == [("b", 1), (None, 2), ("a", 3)]
    codes = woe.level_codes(df, "y", ["f"])
    assert {r.level: r.code for r in codes.collect()} == {"a": "10", "b": "-10", None: "0"}
    coded = woe.apply_level_codes(df, codes, ["f"])
    assert coded.count() == df.count() and coded.where("f is null").count() == 0


def test_grid_and_histogram_edges(spark):
    values = [0.0, 0.01, 0.07, 0.29, 0.57, 0.58, 0.99, 1.0, 0.5] + [i * 0.01 for i in range(101)]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    for r in df.select("p", grid_step(F.col("p")).alias("k"), hundredth_bin(F.col("p")).alias("b")).collect():
        assert r.k == max(i for i in range(101) if i / 100 <= r.p)
        inside = [i for i in range(100) if i * 0.01 < r.p <= (i + 1) * 0.01]
        assert (r.b if 0 <= r.b < 100 else None) == (inside[0] if inside else None), r.p


def test_invariants_on_given_tables(spark):
    from verification.fixtures import CREDIT_FACTORS, CREDIT_NUMERIC, credit_missing
    df = credit_missing(spark, "/root/testdata/sf0.001")
    breaks = quantile.breaks_by_column(quantile.quantile_breaks(df, CREDIT_NUMERIC))
    table = woe.woe_table(woe.bin_counts(df, "y", CREDIT_FACTORS, breaks))
    total = df.count()
    assert {r.n for r in table.groupBy("variable").agg(F.sum("n").alias("n")).collect()} == {total}
    merged = woe.chi_merge(table)
    assert {r.n for r in merged.groupBy("variable").agg(F.sum("n").alias("n")).collect()} == {total}
    assert all(r.iv >= -1e-12 for r in woe.information_value(merged).collect())


def sliced_table(spark, bins, variable="f"):
    rows = [(variable, f"l{i:05d}", None, p + n, p, n, p / 1e6, n / 1e6, float(i)) for i, (p, n) in enumerate(bins)]
    return spark.createDataFrame(rows, "variable string, bin string, position int, n long, pos long, neg long, "
                                       "pct_1 double, pct_0 double, woe double")


@pytest.mark.parametrize("kind", ["noise", "trend", "steps", "one group", "all apart", "late surprise"])
def test_sliced_walk_equals_the_plain_walk(spark, kind):
    """A factor of 10,001 levels over 41 slices, whatever spans their borders."""
    rng = random.Random(kind)
    n = 10_001
    draw = {"noise": lambda i: (rng.randrange(30), rng.randrange(30)),
            "trend": lambda i: (rng.randrange(1, 40) + i // 400, rng.randrange(1, 40)),
            "steps": lambda i: (10 + 40 * (i // 900 % 2), 30),
            "one group": lambda i: (7, 9),
            "all apart": lambda i: (500, 10) if i % 2 else (10, 500),
            "late surprise": lambda i: (40, 2) if i in (249, 250, 3_000) else (6, 6)}[kind]
    bins = [draw(i) for i in range(n)]
    bins = [(p, q) if p + q else (1, 0) for p, q in bins]
    want, at, pos, neg = [], 0, None, None
    for p, q in bins:
        if pos is not None and chi_rule(pos, neg, p, q) <= 2.706:
            pos, neg = pos + p, neg + q
        else:
            at, pos, neg = at + 1, p, q
        want.append(at)
    table = sliced_table(spark, bins).unionByName(sliced_table(spark, bins[:7], "short"))
    got = woe.merge_groups(table, slice_bins=250).collect()
    by_level = {(r.variable, r.bin): r.group for r in got}
    assert len(got) == n + 7
    assert [by_level["f", f"l{i:05d}"] for i in range(n)] == want
    assert [by_level["short", f"l{i:05d}"] for i in range(7)] == want[:7]
    places = {}
    for r in sorted((r for r in got if r.variable == "f"), key=lambda r: r.bin):
        assert r.member == places.get(r.group, 0)
        places[r.group] = r.member + 1


def test_sliced_walk_of_a_wide_factor(spark):
    """Merging, labels and levels of 2,001 levels need no Python worker, so executors need no package."""
    bins = [(3 + i % 5, 4) for i in range(2_001)]
    table = sliced_table(spark, bins)
    plan = woe.merge_groups(table)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "Python" not in plan
    assert woe.merged_levels(woe.merge_groups(table)).count() == 2_001


@pytest.mark.parametrize("cell_rows", [20_000_000, 40, 3])
def test_quantiles_at_any_cell_size(spark, cell_rows):
    """Cells are cut again until none is large, however many rounds that takes."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=900), np.repeat(1.5, 600), rng.integers(0, 4, 500), [-0.0, 1e300, -1e300]])
    y = np.where(np.arange(len(x)) % 5 == 0, np.nan, np.arange(len(x)) % 7)
    df = spark.createDataFrame([(float(a), float(b), None) for a, b in zip(x, y)], "x double, y double, z double").repartition(4)
    probs = [0.0, 0.01, 0.05, 0.25, 1 / 3, 0.5, 0.8, 0.995, 1.0]
    got = {(r.variable, r.probability): r.value for r in quantile.exact_quantiles(df, ["x", "y", "z"], probs, cell_rows).collect()}
    assert len(got) == 2 * len(probs)
    for name, values in (("x", x), ("y", y[~np.isnan(y)])):
        for p in probs:
            assert got[name, p] == pytest.approx(np.quantile(values, p), rel=1e-12), (name, p)
