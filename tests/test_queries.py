"""Every registered query against its SQL, run by DuckDB on the same files."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from freshet.plans import PLANS

DATA = "/root/testdata/sf0.001"
QUERIES = {name: plan.run for name, plan in PLANS.items()}
ORACLES = {name: plan.oracle for name, plan in PLANS.items() if plan.oracle}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in order) for row in want.fetchall())
    assert sorted(tuple(plain(row[c]) for c in columns) for row in got.collect()) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and ORACLES.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    got = entry_point.entry(spark)
    assert got.columns == ["event_type", "avg_v", "n"]
    assert sum(r["n"] for r in got.collect()) == spark.read.parquet(f"{DATA}/events.parquet").count()


@pytest.mark.parametrize("name", ["filter_gt", "filter_eq", "project_cols", "feed_filter", "late_split"])
def test_plans_read_only_what_they_need(spark, name):
    text = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in text
    if name == "filter_gt":
        assert "GreaterThan(value,1.6)" in text
    if name == "feed_filter":
        assert "GreaterThan(value,50.0)" in text
    if name == "late_split":
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_hot_keys_are_aggregated_before_the_shuffle(spark):
    """A key with most rows sends one row per task: partial aggregates sit below the exchange."""
    for name in ("bounded_avg", "stream_running_count", "feed_data", "late_counts", "conform_summary"):
        text = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        exchange = text.index("Exchange hashpartitioning")
        assert "partial_" in text[exchange:], name
        assert "SortAggregate" not in text and "CartesianProduct" not in text, name


def test_small_tables_meet_without_cross_joins(spark):
    for name in ("late_split", "feed_lag", "pipeline_metrics", "pipeline_watermark", "source_metrics"):
        text = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
