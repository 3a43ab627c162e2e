import pytest
from pyspark.sql import functions as F

from helpers import rows
from scoreloom.operators import combine, sample


def ids(df):
    return [r.id for r in df.select("id").collect()]


def test_draws_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 3)
    other = df.repartition(13)
    for draw in (lambda d: sample.sample_n(d, 777, ["id"]), lambda d: sample.sample_share(d, 0.2, ["id"]),
                 lambda d: sample.stratified_split(d, 0.3, "g", ["id"])[0]):
        assert sorted(ids(draw(df))) == sorted(ids(draw(other)))
    assert len(ids(sample.sample_n(df, 777, ["id"]))) == 777
    assert len(ids(sample.sample_n(df, 9999, ["id"]))) == 5000


def test_splits_partition_the_rows(spark):
    df = spark.range(3000).withColumn("g", F.when(F.col("id") % 10 != 0, "big").when(F.col("id") % 20 == 0, "small"))
    for first, second in (sample.split_by_share(df, 0.25, ["id"]), sample.holdout(df, ["id"]),
                          sample.stratified_split(df, 0.3, "g", ["id"])):
        a, b = ids(first), ids(second)
        assert sorted(a + b) == list(range(3000))
    first, _ = sample.stratified_split(df, 0.3, "g", ["id"])
    counts = {r.g: r["count"] for r in first.groupBy("g").count().collect()}
    assert counts == {"big": 810, "small": 45, None: 45}


def test_full_copies_are_sampled_exactly(spark):
    """A third of the rows are one row repeated."""
    hot = spark.range(30_000).select(F.lit(1).alias("id"), F.lit("hot").alias("v"))
    df = hot.unionByName(spark.range(2, 60_002).select(F.col("id").cast("int"), F.lit("x").alias("v")))
    for n in (1, 10, 44_999, 70_000):
        chosen, rest = sample.lowest_hashes(df, F.lit(n), ["id", "v"], "test")
        assert chosen.count() == n and rest.count() == 90_000 - n
        assert chosen.where("v = 'hot'").count() + rest.where("v = 'hot'").count() == 30_000


@pytest.mark.parametrize("strata", [[], ["g"]])
def test_large_edges_are_cut_deeper(spark, monkeypatch, strata):
    """A third of the rows share the key; no edge that is ranked has more than the rows allowed."""
    df = (spark.range(9000).withColumn("key", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")))
          .withColumn("g", F.when(F.col("id") % 7 != 0, "big").when(F.col("id") % 2 == 0, "small")))
    limits = []
    keep = sample.stage
    monkeypatch.setattr(sample, "stage", lambda t, label: limits.append(keep(t, label)) or limits[-1])
    plain = sample.lowest_hashes(df, F.floor(F.col("stratum_rows") * 0.5), ["key"], "test", strata)
    assert len(limits) == len(strata)
    hot = df.where("key = -1").withColumn("h", sample.row_hash(["key"], "test")).first().h
    hashed = df.withColumn("h", sample.row_hash(["key"], "test"))
    rank = hashed.where(F.col("h") < hot).count()
    for wanted in (1, rank - 1, rank + 5, rank + 1500, 8999):
        limits.clear()
        chosen, rest = sample.lowest_hashes(df, F.least(F.lit(wanted), F.col("stratum_rows")), ["key"], "test", strata, edge_rows=20)
        a, b = ids(chosen), ids(rest)
        assert sorted(a + b) == list(range(9000))
        if not strata:
            assert len(a) == wanted
            # rows that no tie concerns are those with the smallest hashes
            order = [r.id for r in hashed.where("key <> -1").orderBy("h").collect()]
            kept = [i for i in a if i % 3]
            assert sorted(kept) == sorted(order[:len(kept)])
        elif wanted in (rank - 1, rank + 5):
            assert len(limits) > 1 and limits[-1].where("__rows > 20").isEmpty()
    whole = sample.lowest_hashes(df, F.floor(F.col("stratum_rows") * 0.5), ["key"], "test", strata, edge_rows=20)
    per = [{r.g: r["count"] for r in t[0].groupBy("g").count().collect()} for t in (plain, whole)]
    if strata:
        assert per[0] == per[1] and set(per[0]) == {"big", "small", None}


def test_repeat_rows_spreads_copies(spark):
    df = spark.createDataFrame([("a", 25_000), ("b", 3), ("c", 0)], "k string, n int")
    out = sample.repeat_rows(df.where("n > 0"), F.col("n"))
    assert {r.k: r["count"] for r in out.groupBy("k").count().collect()} == {"a": 25_000, "b": 3}


def test_under_sampling(spark):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") < 100, "1").otherwise("0"))
    out = sample.under_sample(df, "y", 2.5, ["id"])
    assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {"1": 100, "0": 250}
    assert sample.under_sample(df, "y", 9, ["id"]).count() == 1000
    with pytest.raises(ValueError):
        sample.under_sample(df.where("y = '1'"), "y", 2, ["id"])
    with pytest.raises(ValueError):
        sample.under_sample(df.withColumn("y", F.col("id") % 3), "y", 2, ["id"])


def test_streams_are_independent(spark):
    """A split after a sample still cuts the sample at the share of the split."""
    df = spark.range(20_000)
    taken = sample.sample_n(df, 6000, ["id"])
    first, _ = sample.holdout(taken, ["id"])
    assert abs(first.count() / 6000 - 0.7) < 0.03
    folds = {r.f: r["count"] for r in first.groupBy(sample.modulo_fold(["id"], 3).alias("f")).count().collect()}
    assert set(folds) == {0, 1, 2} and min(folds.values()) > 1200


def test_share_limits(spark):
    df = spark.range(10)
    for bad in (0.0, 1.0, 2):
        with pytest.raises(ValueError):
            sample.sample_share(df, bad, ["id"])
    with pytest.raises(ValueError):
        sample.split_by_share(df, 1.0, ["id"])


LEFT = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")]
RIGHT = [(1, 10), (1, 11), (3, 12), (None, 13), (4, 14)]


@pytest.mark.parametrize("left_all,right_all,how", [
    (True, False, "left"), (False, True, "right"), (False, False, "inner"), (True, True, "full")])
def test_merge_equals_sql_joins(spark, left_all, right_all, how):
    left = spark.createDataFrame(LEFT, "k int, l string")
    right = spark.createDataFrame(RIGHT, "rk int, r int")
    got = combine.merge(left, right, ["k"], ["rk"], left_all, right_all)
    want = left.join(right, left.k == right.rk, how).select(F.coalesce("k", "rk").alias("k"), "l", "r")
    assert rows(got, "k", "l", "r") == rows(want, "k", "l", "r")


def test_merge_rejects_bad_keys(spark):
    left = spark.createDataFrame(LEFT, "k int, l string")
    with pytest.raises(ValueError):
        combine.merge(left, left.withColumnRenamed("l", "m"), ["k"], ["k", "m"])
    with pytest.raises(ValueError):
        combine.merge(left, left, ["k"])


def test_lookup_keeps_the_row_count(spark):
    left = spark.createDataFrame(LEFT, "k int, l string")
    right = spark.createDataFrame(RIGHT, "rk int, r int")
    got = combine.lookup(left, right, ["k"], ["rk"], ["r"])
    assert rows(got, "k", "l", "r") == rows(
        spark.createDataFrame([(1, "a", 10), (1, "b", 10), (2, "c", None), (None, "d", None), (4, "e", 14)],
                              "k int, l string, r int"))


def test_union_widens(spark):
    a = spark.createDataFrame([(1, 2)], "id int, v int")
    b = spark.createDataFrame([(2, 2.5, "x")], "id int, v double, w string")
    out = combine.union_rows(a, b)
    assert dict(out.dtypes)["v"] == "double"
    assert rows(out) == [(1, 2.0, None), (2, 2.5, "x")]


def test_full_join_query_reads_whole_tables(spark):
    """Every lineitem and event is counted, and both sides have keys of their own."""
    from verification.queries import REGISTRY
    sf = "/root/testdata/sf0.001"
    rows = REGISTRY["join_full_tables"](spark, sf).collect()
    for name, column in (("lineitem", "n_items"), ("events", "n_events")):
        assert sum(r[column] or 0 for r in rows) == spark.read.parquet(f"{sf}/{name}.parquet").count()
    assert any(r.n_items is None for r in rows) and any(r.n_events is None for r in rows)
