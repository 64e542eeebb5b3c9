"""Driver contract: entry() runs, every query has a callable, oracle keys are
a subset of queries, and a sample of queries matches DuckDB on sf0.001."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from burnlens.plans import catalog
from tools_check import table_hash

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "OpportunityScore" in df.columns


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 80
    assert set(o) <= set(q)
    for name in catalog.all_queries():  # the corpus queries' names are theirs
        assert not re.match(r"op\d+_", name) and name != "pipeline"


@pytest.mark.parametrize(
    "name",
    ["route_summary", "segment_zscores", "route_opportunity", "segment_opportunity", "anomaly_monitor",
     "bias_report", "value_summary", "what_if", "scoreboard_gaps", "box_summary"],
)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert len(srows) == len(drows)
    assert sorted(sdf.columns) == sorted(dcols)
    assert table_hash(srows, sdf.columns) == table_hash(drows, dcols)
