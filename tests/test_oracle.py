"""Every registered query against SQL on the same tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

from __spark_entry__ import entry
from oracle.measures import oracle_sql
from storelens import catalog

FOLDER = "/root/testdata/sf0.001"
CHECKS = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_check():
    assert set(CHECKS) == set(catalog.QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(name, spark, connection):
    assert difference(catalog.run(name, spark, FOLDER), connection, CHECKS[name]) is None


@pytest.mark.parametrize("name", ["m13_acquisition_rate", "s2_refreshed_months", "mi4_freshness", "q7_days_without_calendar"])
def test_time_zone_of_the_caller_does_not_matter(name, spark, connection):
    """A session of another zone gives the same rows, and keeps its settings."""
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    assert difference(catalog.run(name, other, FOLDER), connection, CHECKS[name]) is None
    assert other.conf.get("spark.sql.session.timeZone") == "America/Los_Angeles"
