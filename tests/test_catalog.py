"""Every catalog query against its SQL in DuckDB, and the shape of the plans."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from waycast.operators import matching, streams
from waycast.sources import tables

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    order = [d[0] for d in cursor.description]
    wanted = Counter(tuple(row[order.index(c)] for c in columns) for row in cursor.fetchall())
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    assert Counter(map(tuple, df.select(*columns).collect())) == wanted
    assert wanted.total() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 1958


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_pairs_everything(spark, sf_dir):
    for name in QUERIES:
        if not name.startswith("stream_"):
            plan = plan_of(QUERIES[name](spark, sf_dir))
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
            assert "BatchEvalPython" not in plan, name


def test_busy_routes_have_no_pairing_either(spark, sf_dir):
    events = streams.apply_lead_time(tables.read_events(spark, sf_dir))
    plan = plan_of(matching.all_alerts(matching.trace(events, rows_per_chunk=20)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    plan = plan_of(QUERIES["src_requests"](spark, sf_dir))
    assert "PushedFilters: [In(event_type" in plan or "EqualTo(event_type" in plan
    assert "value:double" not in plan and "props:string" not in plan
