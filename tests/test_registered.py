"""Every registered query against the same query in SQL, and the shape of the plans."""

import glob
import os
import re

import pytest

import __spark_entry__ as contract
from airwave.checks.oracle import statements
from airwave.checks.queries import registered
from airwave.plans.enrich import enrich
from airwave.sources.events import read_event_snapshots

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def by_name(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_same_names():
    assert set(registered()) == set(statements())
    assert set(registered()) <= set(contract.queries())
    assert set(statements()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(registered()))
def test_query_equals_sql(spark, duck, name):
    df = registered()[name](spark, DATA)
    found = duck.execute(statements()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    rows = found.fetchall()
    assert rows
    assert by_name(df.collect(), df.columns) == by_name(rows, columns)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["enrich_base", "streamer_summary", "viewer_histogram",
                                  "viewer_describe", "top_games_hourly", "missing_batches"])
def test_no_cross_join_and_no_python_in_plans(spark, name):
    text = plan(contract.queries()[name](spark, DATA))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin, Cross", "Python", "ArrowEval"):
        assert word not in text, word


def test_wide_rows_shuffle_once_and_copies_are_dropped_before(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(enrich(read_event_snapshots(spark, DATA), "2026-01-01"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [re.sub(r"#\d+L?", "", line) for line in text.splitlines()]
    tree = [line for line in lines if "+-" in line or ":-" in line]
    # Under the last join, the wide side is Window over its one exchange: no second exchange.
    join = next(i for i, line in enumerate(tree) if "SortMergeJoin" in line)
    wide = []
    for line in tree[join + 1:]:
        if "Scan" in line:
            break
        wide.append(line)
    assert sum("Exchange" in line for line in wide) == 1
    kinds = [k for line in wide for k in ("Exchange", "Partial", "Final") if k in line]
    assert kinds == ["Final", "Exchange", "Partial"]


def test_scan_reads_only_needed_columns(spark):
    text = plan(contract.queries()["hourly_summary"](spark, DATA))
    assert "event_type" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_top_lists_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(contract.queries()["fastest_growing_streams"](spark, DATA))


def test_entry(spark):
    assert contract.entry(spark).count() > 0
