"""Every registered query against its SQL equivalent in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = os.environ.get("TEST_SF_DIR", contract.SMOKE_DIR)
# All-pairs joins, and Python that runs row by row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows_of(table):
    table = table.select(sorted(table.column_names))
    return sorted(zip(*[c.to_pylist() for c in table.columns]), key=repr)


def types_of(table):
    return {f.name: str(f.type).replace("[ns]", "[us]") for f in table.schema}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got, want = df.toArrow(), duck.sql(ORACLES[name]).to_arrow_table()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in UNWANTED if bad in plan]
    assert types_of(got) == types_of(want)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    out = contract.entry(spark)
    assert {"ts_hour", "event_type", "n", "lag_168h", "rolling_7d_mean"} <= set(out.columns)
    assert out.count() > 0


def test_flagship_scans_events_once(spark):
    out = QUERIES["hourly_features"](spark, SF)
    out.toArrow()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in (
        out._jdf.queryExecution().executedPlan().toString())
