import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert df.columns == ["model", "delta", "phi"]
    assert {r["model"] for r in rows} == {"standard", "fair"}


def test_oracle_keys_are_queries():
    assert set(se.oracle_sql()) <= set(se.queries())
    own = {k for k in se.queries() if k in se._queries.QUERIES}
    assert own - set(se.oracle_sql()) == se.NO_ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle_sf0001(spark, con, name):
    df = se.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(se.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    want = Counter(tuple(_norm(r[idx[c]]) for c in cols) for r in rel.fetchall())
    assert got == want
