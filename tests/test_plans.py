"""Plan checks: no Python evaluation, no nested-loop joins on row data, no
single-partition exchange, filters and projections pushed into scans."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strata.queries import QUERIES

from .conftest import SF_SMALL

ALLOWED_SINGLE_PARTITION = {
    # one-row global aggregates and the top-1 report: the single partition holds partial results only
    "pnl_gmv", "pnl_gmv_from_two_facts", "pnl_total_revenue", "pnl_total_expense", "pnl_net_profit", "pnl_ebitda", "latest_batch",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    if name not in ALLOWED_SINGLE_PARTITION:
        assert "SinglePartition" not in p, name


def test_window_filter_reaches_the_scan(spark):
    # window_delta ORs over a key computed in the query, which no scan can
    # evaluate; a window over stored keys is pushed into the Parquet reader
    p = plan(QUERIES["load_full"](spark, SF_SMALL))
    assert "PushedFilters: [" in p and "ts" in p.split("PushedFilters: [")[1].split("]")[0]


def test_projection_pruned(spark):
    p = plan(QUERIES["load_multi_db"](spark, SF_SMALL).select("o_orderkey", "source_db_id", "o_totalprice"))
    schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_custkey" not in schema and "o_orderpriority" not in schema


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_listing_scans_services_once_and_bookings_once_per_role(spark):
    import re
    p = plan(QUERIES["listing_union"](spark, SF_SMALL))
    scans = re.findall(r"FileScan parquet.*?/(\w+)\.parquet", p)
    assert scans.count("part") <= 2      # services, and their travelers
    assert scans.count("orders") <= 5    # bookings, the rollup's bookings, origin-destination, two travelers


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and len(df.columns) == 9
