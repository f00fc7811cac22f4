import pytest

import __spark_entry__ as contract
from checks.queries import QUERIES
from checks.compare import compare, oracle_connection
from tests.conftest import SF_DIR, plan_text


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    assert compare(oracle, name, contract.queries()[name](spark, SF_DIR)) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything(spark, name):
    plan = plan_text(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "EvalPython" not in plan
    assert "RoundRobinPartitioning" not in plan
