"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(frame: pd.DataFrame):
    out = []
    for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False):
        out.append(tuple(None if pd.isna(v) else v if isinstance(v, (str, bool)) else float(v) for v in r))
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLES[name]).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
