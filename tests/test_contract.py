"""Driver contract: entry(), queries() and oracle_sql() agree with DuckDB."""

import duckdb
import pytest

import __spark_entry__ as E
from quire.sources.tables import TABLES
from tools.check import digest


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"book_id", "chapter_no", "file_text", "n_chars"} <= set(df.columns)


def test_every_query_has_an_oracle():
    from quire.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, small, duck, name):
    df = E.queries()[name](spark, small)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]
