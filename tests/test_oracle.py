"""Level 1: every registered query against its DuckDB oracle (sf0.001 in
the unit suite; the driver repeats this at sf0.01)."""

import pytest

from starloom.plans.compare import compare
from starloom.plans.oracle import ORACLE
from starloom.plans.queries import REGISTRY

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck001, name):
    if name not in ORACLE:
        df = REGISTRY[name](spark, SF001)
        assert df.count() >= 0
        return
    r = compare(spark, duck001, REGISTRY[name], ORACLE[name], SF001)
    assert r["ok"], r


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_in_plans(spark, name):
    """Every registered query stays on the JVM: no Python UDF evaluation,
    no collect of a Python RDD in its plan."""
    df = REGISTRY[name](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                 "FlatMapGroupsInPandas", "PythonRDD"):
        assert node not in plan, (name, node)


def test_queries_pin_their_session_settings(spark, duck001):
    """A driver session in another zone still gets UTC results."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, duck001, REGISTRY["payload_rows"], ORACLE["payload_rows"], SF001)
        assert r["ok"], r
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
