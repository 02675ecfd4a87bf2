import pytest
from oracle_check import connect, differences

import __spark_entry__ as driver
from pairloom.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_sql_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data, con, name):
    assert differences(driver.queries()[name](spark, data), con, driver.oracle_sql()[name]) == []


def test_approximate_search(spark, data):
    rows = driver.queries()["vector_topk_ivf"](spark, data).collect()
    assert len(rows) == 5 * 500


def test_adapter_loss_falls(spark, data):
    losses = [r.loss for r in driver.queries()["adapter_training"](spark, data).orderBy("epoch").collect()]
    assert losses == sorted(losses, reverse=True)


def test_pipeline_checks_pass(spark, data):
    assert [r.passed for r in driver.queries()["end_to_end"](spark, data).collect()] == [True] * 4


def test_entry(spark):
    assert driver.entry(spark).count() > 0
