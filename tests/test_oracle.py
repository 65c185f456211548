"""Every registered query against its DuckDB oracle at sf0.01 (row count,
column names, order-insensitive value hash)."""

import duckdb
import pytest

from tools.check_oracle import digest

from strata.plans.sql_oracle import ORACLE
from strata.queries import QUERIES
from strata.sources.tables import FIXTURE_TABLES

from .conftest import SF_ORACLE

SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in FIXTURE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_ORACLE)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    o_cols = [d[0] for d in res.description]
    o_rows = [tuple(r) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(o_cols)
    rel = duck.sql(ORACLE[name])
    assert {c: SPARK_TO_DUCKDB.get(t, t) for c, t in df.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert len(s_rows) == len(o_rows)
    hs, ls = digest(df.columns, s_rows)
    ho, lo = digest(o_cols, o_rows)
    assert hs == ho, (sorted(set(ls) - set(lo))[:3], sorted(set(lo) - set(ls))[:3])
