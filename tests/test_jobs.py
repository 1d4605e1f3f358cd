"""Every registered job against its SQL on the practice tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.01"
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()
JOBS, CHECKS = entry_points.JOBS, entry_points.CHECKS


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_check_has_a_job():
    assert set(SQL) <= set(QUERIES)
    assert set(JOBS) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_job_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
