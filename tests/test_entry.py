"""The registered queries against their DuckDB counterparts on the smallest tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import compare, connect
from checks.oracle import ORACLE
from eventward.plans.queries import QUERIES
from tests.conftest import SF

MODELS = {"train_and_score", "important_features", "reports_of_scored_events", "stream_score"}


def test_every_query_but_the_models_has_sql():
    assert set(QUERIES) - set(ORACLE) == MODELS
    assert not set(driver.oracle_sql()) - set(driver.queries())


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(driver.oracle_sql())))
def test_query_equals_sql(spark, duck, name):
    line = compare(spark, duck, SF, name)
    assert line.startswith("ok"), line


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.count() > 0 and "events_last_5min_user" in rows.columns
