"""Every registered query against its SQL, and what its plan must not contain."""

import pytest

import __spark_entry__ as entrypoint
import check
from tuneframe.queries import ORACLES, QUERIES

# The one query that shows the hook for a Python tokenizer.
WITH_PYTHON = {"final_length_with_tokenizer"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, sf_dir, name):
    assert check.compare(spark, con, sf_dir, name, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in WITH_PYTHON:
        assert "EvalPython" not in plan
        assert "MapInPandas" not in plan


def test_entry(spark):
    rows = entrypoint.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["total"] > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entrypoint.queries())
