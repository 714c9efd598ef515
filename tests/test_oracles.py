"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracles import compare, connect  # noqa: E402

from tallyline import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = list(catalog.queries())  # the subpackage for training text has tests of its own

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# The only operator with Python in its tasks: block scoring of the similarity recommendation.
PYTHON = {"recommend_similar", "paginate", "recommend_similar_table", "recommendation_messages"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert ("MapInPandas" in plan) == (name in PYTHON)
    verdict, _, _ = compare(spark, con, name, SF, df)
    assert verdict.startswith("ok"), verdict


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["rule", "active_date", "create_date", "date_diff", "channel_code", "area", "fact_count"]
    assert df.limit(1).count() == 1


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracles())
    assert set(NAMES) <= set(contract.queries()) and set(NAMES) <= set(contract.oracle_sql())
