"""Every registered query against its DuckDB oracle (sf0.001), plus plan-shape checks."""

import re

import pytest

import __spark_entry__ as E
from tidewater.plans.oracle_check import compare, duck_connection

from conftest import SF001

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF001)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    """Rows, values and types, from one run of the query."""
    sdf = QUERIES[name](spark, SF001)
    ok, msg = compare(sdf, con, SQL[name])
    assert ok, msg
    rel = con.sql(SQL[name])
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in sdf.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck[f.name], (f.name, f.dataType, duck[f.name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF001).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "w180_goals_per90" in df.columns


@pytest.mark.parametrize("name", ["lookback_rates", "error_by_position", "calibration_deciles", "score_bands",
                                  "event_lookback", "report_risks"])
def test_no_python_in_plans(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_split_predicate_pushed_to_scan(spark):
    from tidewater.plans.star_queries import split_frames
    train, test, _ = split_frames(spark, SF001)
    # the anchor table is a written Parquet table: the split bound reaches its scan
    assert "PushedFilters: [IsNotNull(anchor_date), IsNotNull(o_orderdate), GreaterThanOrEqual(anchor_date" in \
        test._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(anchor_date" in train._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    plan = QUERIES["group_performance"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "l_orderkey", "l_suppkey", "l_quantity", "l_linenumber", "l_returnflag"}
