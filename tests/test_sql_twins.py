"""Every registered query equals its SQL twin, has a stable schema and a plan without pair explosions."""

import pytest

import __spark_entry__ as entry
from opslens.plans import catalog
from tools.check_sql import compare, connect

SQL = entry.oracle_sql()
QUERIES = {n: q for n, q in entry.queries().items() if n in catalog.queries()}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, sf_dir, name):
    diff, rows = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
    assert diff is None
    assert rows > 0


PLANNED = sorted(n for n in QUERIES if not n.startswith(("stream_", "csv_stream", "ingest_directory", "view_daily", "sink_json")))


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_pairs_and_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ts", "region", "p95_ms", "timeout_rate", "rtt", "cpu_max", "calls"]
    assert df.count() > 0
