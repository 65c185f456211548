"""The SQL of this subpackage's queries against their Spark results."""

import duckdb
import pytest

from strata.llm.oracle import ORACLE
from strata.llm.queries import QUERIES
from strata.sources.tables import FIXTURE_TABLES
from tests.conftest import SF_ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in FIXTURE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    df = QUERIES[name](spark, SF_ORACLE)
    names = sorted(df.columns)
    got = sorted(str(tuple(r)) for r in df.select(names).collect())
    assert got == sorted(str(r) for r in con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
