"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as contract
from tests.compare import DATA, compare, duck

FOLDER = DATA / "sf0.001"
NAMES = list(contract._base())


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    """Same rows as the SQL; no pair-by-pair join and no Python in the plan."""
    frame = contract.queries()[name](spark, str(FOLDER))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan, operator
    assert compare(frame, connection, contract.oracle_sql()[name]) is None


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0 and "incident_severity_score" in frame.columns
