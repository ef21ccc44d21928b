import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# Every query that has oracle SQL, on the smallest tables.
SMALL = sorted(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and "duplicates" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 75


def _norm(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9))
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SMALL)
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    s_rows = sorted(tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    d_rows = sorted(tuple(_norm(r[dcols.index(c)]) for c in sorted(dcols)) for r in cur.fetchall())
    assert s_rows == d_rows
