import pytest
from pyspark.sql import functions as F

from helpers import rows
from scoreloom.operators import audit, clean, profile
from scoreloom.roles import Dataset
from scoreloom.sources import artifacts, delimited, tables


def passed(df):
    return {r.check: r.passed for r in df.collect()}


def test_audits(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "id int, y string")
    assert passed(audit.audit_id(df, "id")) == {"id_exists": True, "id_unique": False, "id_not_null": False}
    assert passed(audit.audit_id(df, "nope")) == {"id_exists": False}
    assert passed(audit.audit_label(df, "y")) == {"label_exists": True, "label_not_null": False}
    assert passed(audit.audit_label(df, "nope")) == {"label_exists": False}
    assert passed(audit.audit_volume(df, "id", "y")) == {"volume_rows": False, "volume_columns": False}
    assert passed(audit.audit_volume(df, "id", None, min_rows=3)) == {"volume_rows": True, "volume_columns": True}
    audit.require(audit.audit_id(spark.range(5), "id"))
    with pytest.raises(audit.AuditError, match="id_unique"):
        audit.require(audit.audit_id(df, "id"))


def test_dictionary_audit(spark):
    good = spark.createDataFrame([("variable", "type", None), ("a", "numeric", None), ("b", "factor", None)],
                                 "variable string, type string, extra string")
    assert all(passed(audit.audit_dictionary(good, header_in_rows=True)).values())
    bad = spark.createDataFrame([("a", "numeric", "x"), ("a", "text", None), ("c", None, None)],
                                "variable string, type string, extra string")
    assert not any(passed(audit.audit_dictionary(bad, header_in_rows=True)).values())
    names = audit.audit_columns(spark.createDataFrame([(1, 2)], "a int, z int"),
                                good.where("variable <> 'variable'"))
    assert rows(names) == [("b", "dictionary_only"), ("z", "table_only")]


def test_dictionary_file(spark, tmp_path):
    path = tmp_path / "dict.csv"
    path.write_text('variable,type\n"id", Double \nv1,STRING\nv2,numeric\nseen,Date\n v3 ,factor\n')
    types = delimited.read_dictionary(spark, str(path), ["int", "double"], ["string", "char"])
    assert list(types.items()) == [("id", "numeric"), ("v1", "factor"), ("v2", "numeric"), ("v3", "factor")]
    path.write_text("variable,type\na,numeric\na,factor\n")
    with pytest.raises(audit.AuditError, match="no_repeats"):
        delimited.read_dictionary(spark, str(path))
    path.write_text("name,type\na,numeric\n")
    with pytest.raises(audit.AuditError):
        delimited.read_dictionary(spark, str(path))


def test_csv_missing_spellings(spark, tmp_path):
    path = tmp_path / "data.csv"
    cells = [*delimited.MISSING_SPELLINGS, " 4.5 ", "oops"]
    path.write_text("n,f,other\n" + "".join(f"{c},{c},1\n" for c in cells))
    df = delimited.read_declared(spark, str(path), {"f": "factor", "n": "numeric"})
    assert df.columns == ["f", "n"]
    assert rows(df.where("f is not null")) == [("4.5", 4.5), ("oops", None)]
    assert df.where("f is null and n is null").count() == len(delimited.MISSING_SPELLINGS)
    with pytest.raises(ValueError):
        delimited.read_declared(spark, str(path), {"absent": "factor"})


def test_csv_without_header_and_inferred(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text("1;x;?\n2;y;3.5\n")
    df = delimited.read_declared(spark, str(path), {"a": "numeric", "b": "factor", "c": "numeric"}, ";", header=False)
    assert rows(df) == [(1.0, "x", None), (2.0, "y", 3.5)]
    path.write_text("a,b,c\n1,x,NA\n2,7,3.5\n")
    df, types = delimited.read_inferred(spark, str(path))
    assert types == {"a": "numeric", "b": "factor", "c": "numeric"}
    assert rows(df) == [(1.0, "x", None), (2.0, "7", 3.5)]
    with pytest.raises(ValueError):
        delimited.read_inferred(spark, str(path), header=False)


def test_large_ids_stay_apart(spark):
    big = [2 ** 53, 2 ** 53 + 1, 10 ** 15 + 1]
    want = sorted((str(i),) for i in big)
    for kind in ("bigint", "string"):
        df = spark.createDataFrame([(i,) for i in big], "i bigint").select(F.col("i").cast(kind).alias("i"))
        assert rows(tables.as_declared(df, {"i": "numeric"}, "i")) == want
    odd = spark.createDataFrame([("1.0",), ("0.5",), ("x",), ("NaN",), (None,)], "i string")
    assert [r.i for r in tables.as_declared(odd, {"i": "numeric"}, "i").collect()] == ["1", "0.5", None, None, None]


def test_typing_and_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 1.5, "7")], "i int, d double, s string")
    out = tables.as_declared(df, {"d": "numeric", "s": "numeric", "i": "factor"})
    assert out.dtypes == [("d", "double"), ("s", "double"), ("i", "string")]
    assert rows(out) == [(1.5, 7.0, "2"), (None, None, "1")]
    with pytest.raises(ValueError):
        tables.as_declared(df, {"absent": "numeric"})


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a,b", ["x", "y"]), ('q"', None)], "s string, l array<string>")
    artifacts.write_csv(df, str(tmp_path / "t.csv"))
    artifacts.write_csv(df, str(tmp_path / "t.csv"))
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "t.csv"))
    assert rows(back, "s") == [("a,b",), ('q"',)]
    artifacts.write_report_set({"one": df, "two": df.limit(1)}, str(tmp_path), "rep")
    assert spark.read.json(str(tmp_path / "rep.json")).groupBy("table").count().count() == 2
    assert spark.read.text(str(tmp_path / "rep.txt")).count() == 3


def test_numeric_profile_all_missing(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    got = {r.variable: r for r in profile.numeric_profile(df, ["a", "b"]).collect()}
    assert (got["a"].max, got["a"].min, got["a"].mean, got["a"].median, got["a"].missing_count) == (3, 1, 2, 2, 1)
    assert got["b"].max is None and got["b"].median is None and got["b"].missing_count == 3


def test_factor_profile_ties_and_long_lists(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "y"), ("a", "z"), ("b", None)], "f string, g string")
    got = {r.variable: tuple(r)[1:] for r in profile.factor_profile(df, ["f", "g"]).collect()}
    assert got == {"f": (2, 1, "a", "a|b"), "g": (3, 1, "x", "x|y|z")}
    short = {r.variable: r.levels for r in profile.factor_profile(df, ["f", "g"], join_up_to=2).collect()}
    assert short == {"f": "a|b", "g": None}
    assert profile.level_domain(df, ["g"]).count() == 3


def test_profile_input(spark):
    df = spark.range(12_000)
    assert profile.profile_input(df, None, ["id"]) is df
    assert profile.profile_input(df, "auto", ["id"]) is df  # 20,000 exceeds the table
    assert profile.profile_input(df, 500, ["id"]).count() == 500
    assert profile.profile_input(df, 99_999, ["id"]) is df
    assert 0 < profile.profile_input(df, 0.1, ["id"]).count() < 3000
    with pytest.raises(ValueError):
        profile.profile_input(df, 1.5, ["id"])


def test_drop_rules(spark):
    df = spark.createDataFrame([(None, None, 1), (1, None, 1), (1, 2, 3)], "a int, b int, c int")
    assert clean.drop_sparse_rows(df, ["a", "b", "c"], 0.4).count() == 2  # int(1.2) = 1 missing allowed
    assert clean.drop_sparse_rows(df, ["a", "b", "c"], 0.0).count() == 1
    numeric = spark.createDataFrame([("n1", 0.0, 0), ("n2", 0.0, 1), ("n3", 1.0, 9)],
                                    "variable string, sigma double, missing_count long")
    factor = spark.createDataFrame([("f1", 1, 0), ("f2", 1, 2), ("f3", 6, 0), ("f4", 5, 0)],
                                   "variable string, level_num long, missing_count long")
    got = rows(clean.droppable_variables(numeric, factor, 10, 0.5, 0.9))
    assert got == [("f1", "constant_factor"), ("f3", "too_many_levels"), ("n1", "constant_numeric"), ("n3", "sparse")]
    assert ("f3", "too_many_levels") not in rows(clean.droppable_variables(numeric, factor, 10, 6, 0.9))


def test_fill(spark):
    df = spark.createDataFrame([(None, None), (2.0, "x"), (2.0, "x"), (3.0, "w")], "n double, f string")
    learned = clean.learned_fill(profile.numeric_profile(df, ["n"]), profile.factor_profile(df, ["f"]))
    values = clean.fill_values(learned, {"f": "mine"})
    assert values == {"n": "2.0", "f": "mine"}
    assert rows(clean.fill_missing(df, values))[-1] == (3.0, "w")
    assert clean.fill_missing(df, values).where("n is null or f is null").count() == 0


def test_roles_and_categories(spark):
    data = Dataset(spark.createDataFrame([(1.0, "a", 2.0, 1.5)], "id double, f string, n double, y double"),
                   {"id": "numeric", "f": "factor", "n": "numeric", "y": "numeric"}, "id", "y")
    assert (data.variables, data.numeric, data.factors) == (["f", "n"], ["n"], ["f"])
    assert data.without(["f"]).df.columns == ["id", "n", "y"]
    assert rows(clean.as_categories(data.df, "id", "y")) == [("1", "a", 2.0, "1.5")]
